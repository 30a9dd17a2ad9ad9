"""Randomized checks against brute-force Python on small inputs."""
from hypothesis import given, settings, HealthCheck, strategies as st

from tideline.functions import schemas as S
from tideline.operators import dau, orders
from tideline.operators.upsert import keyed_upsert

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

order_rows = st.lists(st.tuples(st.integers(1, 3),      # user
                                st.integers(1, 6),      # order id (repeats = duplicate delivery)
                                st.sampled_from(["2020-01-01 00:00:00", "2020-01-02 00:00:00",
                                                 "2020-01-03 00:00:00"])),
                      min_size=1, max_size=14)
states = st.dictionaries(st.integers(1, 3), st.tuples(st.sampled_from(["0", "1"]), st.integers(1, 6)),
                         max_size=3)


def brute_flags(rows, state):
    """rows: (user, id, create_time, offset); the T2 rule with replay safety."""
    out = {}
    for u in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == u]
        consumed, first_id = state.get(u, (None, None))
        cand = [r for r in mine if consumed != "1" or r[1] == first_id]
        winner = min(cand, key=lambda r: (r[2], r[1], r[3])) if cand else None
        for r in mine:
            out[r[3]] = "1" if r is winner else "0"
    return out


@SETTINGS
@given(rows=order_rows, state=states)
def test_first_order_flags_match_brute_force(spark, rows, state):
    rows = [(u, i, ct, off) for off, (u, i, ct) in enumerate(rows)]
    df = spark.createDataFrame([("t", 0, off, u, i, ct) for u, i, ct, off in rows],
                               "topic string, partition int, offset long, user_id long, id long, create_time string")
    st_df = spark.createDataFrame([(str(u), c, fid if c == "1" else None) for u, (c, fid) in state.items()],
                                  S.USER_STATE)
    got = {r.offset: r.if_first_order for r in orders.first_order_flags(df, st_df).collect()}
    assert got == brute_flags(rows, state)


starts = st.lists(st.tuples(st.sampled_from(["m1", "m2"]),
                            st.integers(0, 3) .map(lambda d: 1704067200000 + d * 43200000),
                            st.sampled_from(["a", "b", "c"])), min_size=1, max_size=12)


@SETTINGS
@given(events=starts)
def test_first_launch_matches_brute_force(spark, events):
    import datetime as dt
    rows = [(m, ts, ch, off) for off, (m, ts, ch) in enumerate(events)]
    df = spark.createDataFrame([("t", 0, off, m, ts, ch, ts) for m, ts, ch, off in rows],
                               "topic string, partition int, offset long, mid string, ts long, ch string, t2 long")
    df = dau.with_day_parts(df)
    got = {(r.dt, r.mid): r.offset for r in dau.first_launches(df).collect()}
    want = {}
    for m, ts, ch, off in sorted(rows, key=lambda r: (r[1], r[3])):
        day = dt.datetime.fromtimestamp(ts / 1000, dt.timezone.utc).strftime("%Y-%m-%d")
        want.setdefault((day, m), off)
    assert got == want


kv = st.dictionaries(st.integers(0, 6), st.sampled_from(["x", "y", "z"]), max_size=6)


@SETTINGS
@given(base=kv, upd=kv)
def test_keyed_upsert_is_dict_update_and_idempotent(spark, base, upd):
    schema = "id long, v string"
    b = spark.createDataFrame(list(base.items()), schema)
    u = spark.createDataFrame(list(upd.items()), schema)
    once = keyed_upsert(b, u, ["id"])
    want = dict(base)
    want.update(upd)
    assert dict((r.id, r.v) for r in once.collect()) == want
    assert sorted(keyed_upsert(once, u, ["id"]).collect()) == sorted(once.collect())


envelopes = st.lists(st.tuples(
    st.sampled_from(["order_info", "base_province", "user_info", "order_detail", "sku_info", "other", "ORDER_INFO"]),
    st.sampled_from(["insert", "update", "delete", "bootstrap-insert", None]),
    st.one_of(st.none(), st.just({}), st.integers(1, 99).map(lambda i: {"id": i, "x": "y"}))),
    min_size=1, max_size=15)


@SETTINGS
@given(envs=envelopes)
def test_object_router_matches_python_rule(spark, envs):
    import json
    from tideline.operators import cdc
    listed = {"base_province", "user_info", "spu_info", "sku_info", "base_category3", "base_trademark",
              "order_detail"}
    rows = [("t", 0, i, None, json.dumps({"table": t, "type": ty, "data": d})) for i, (t, ty, d) in enumerate(envs)]
    routed, rejects = cdc.route_object(spark.createDataFrame(rows, S.MESSAGE))
    want = sorted(("ODS_T_" + t.upper(), str(d["id"])) for t, ty, d in envs
                  if d and ty is not None and ty != "delete"
                  and ((t == "order_info" and ty == "insert") or t in listed))
    assert sorted((r.topic, r.key) for r in routed.collect()) == want
    assert rejects.count() == sum(1 for _, ty, d in envs if d is None or ty is None)


# (partition, offset); a batch covers consecutive offsets, as a topic delivers them.
msgs_in_batches = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30)),
                           min_size=1, max_size=20, unique_by=lambda t: t).map(
    lambda xs: [(p, o, o // 7) for p, o in xs])
old_ledger = st.dictionaries(st.integers(0, 3), st.integers(0, 40), max_size=4)


@SETTINGS
@given(msgs=msgs_in_batches, old=old_ledger)
def test_ledger_is_max_until_and_never_moves_back(spark, msgs, old):
    from tideline.operators import offsets
    df = spark.createDataFrame([("t", p, o, None, "v", b) for p, o, b in msgs],
                               "topic string, partition int, offset long, key string, value string, batch_id int")
    ranges = offsets.offset_ranges(df)
    fresh = {r.partition: r.until_offset for r in offsets.ledger_after(ranges, "g").collect()}
    want = {}
    for p, o, b in msgs:
        want[p] = max(want.get(p, 0), o + 1)
    assert fresh == want
    existing = spark.createDataFrame([("g", "t", p, u) for p, u in old.items()], S.OFFSET_LEDGER)
    merged = {r.partition: r.until_offset for r in offsets.ledger_after(ranges, "g", existing=existing).collect()}
    for p in set(old) | set(want):
        assert merged[p] == max(old.get(p, 0), want.get(p, 0))
