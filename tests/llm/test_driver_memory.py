"""What the pipeline leaves on the driver, and rows that no pair of near copies needs."""
import gc

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import functions as F

from tideline.llm import common, jaccard_join, toxicity


def _corpus(spark):
    words = "river stone paper garden window summer letter music".split()
    rows = [(i, " ".join(words[(i + k) % 8] for k in range(6)) + (" idiot scum moron" if i % 3 == 0 else "")) for i in range(120)]
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
            spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))


def test_drop_toxic_leaves_no_model_on_the_driver(spark, monkeypatch):
    docs, labels = _corpus(spark)
    sent, returned, broadcast = [], [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(broadcast(self, value)) or sent[-1])
    monkeypatch.setattr(toxicity, "_give_back", lambda f=toxicity._give_back: returned.append(pa.total_allocated_bytes()) or f(), raising=False)
    gc.collect()
    kept = toxicity.drop_toxic(docs, labels)
    assert len(sent) == 2 and not any(b._jbroadcast.isValid() for b in sent)
    assert len(returned) == 3  # vocabulary, document counts, examples
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 0").collect()} and 0 < len(ids) < 120


def test_examples_are_put_in_order(spark):
    kind = pa.list_(pa.int32())
    parts = [([5, 1], [9, 3], [1, 0], [[4, 6], []], [[1, 2], []]), ([1, 7], [2, 1], [1, 1], [[8], [2, 3, 9]], [[5], [1, 1, 7]])]
    names = [common.RID, "doc_id", "toxic", "ids", "counts"]
    batches = [pa.record_batch([pa.array(a), pa.array(b), pa.array(c, pa.int32()), pa.array(d, kind), pa.array(e, kind)], names) for a, b, c, d, e in parts]
    for table in (pa.Table.from_batches(batches), pa.Table.from_batches(batches).slice(1, 2), pa.Table.from_batches(batches[:1]).slice(0, 0)):
        want = table.sort_by([("doc_id", "ascending"), (common.RID, "ascending")]).drop_columns(common.RID)
        assert toxicity._in_order(table).to_pylist() == want.to_pylist()


def test_shingles_of_linked_members_alone_join_no_pair(spark, monkeypatch):
    """Hub 0 with 40 linked members that share shingles 1 to 8, one unlinked that shares 100 to 139 with one of them."""
    rows = [(x, 0, 200, 20, True, list(range(1, 9)) + [1000 + x]) for x in range(1, 41)]
    rows += [(41, 0, 200, 44, True, list(range(100, 140)) + [1, 2, 3, 4]), (42, 0, 200, 45, False, list(range(100, 140)) + [50, 51, 52, 53, 54])]
    near = spark.createDataFrame(rows, "x long, y long, nx long, gap long, linked boolean, delta array<long>")
    made, saved = [], jaccard_join.saved
    monkeypatch.setattr(jaccard_join, "saved", lambda df, *a: made.append(saved(df, *a)) or made[-1])
    pairs = {tuple(r) for r in jaccard_join._near_pairs(near).collect()}
    assert (41, 42) in pairs
    joined = [df.filter(F.col("t") < 9).count() for df in made if {"x", "t"} <= set(df.columns)]
    assert joined[0] == 40 * 8 + 4 and not any(joined[1:])


def test_near_pairs_joins_members_not_shingles(spark, monkeypatch):
    """Two hubs with members that hold 30 of 60 shingles in runs: the joins before the prefix see a row a member, and few tables are written."""
    rows = [(100 * h + i, h, 200, 30, i % 3 == 0, [1000 * h + (2 * i + k) % 60 for k in range(30)]) for h in (1, 2) for i in range(1, 21)]
    near = spark.createDataFrame(rows, "x long, y long, nx long, gap long, linked boolean, delta array<long>")
    plans, saved = [], jaccard_join.saved
    monkeypatch.setattr(jaccard_join, "saved", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or saved(df, *a))
    pairs = {tuple(r) for r in jaccard_join._near_pairs(near).collect()}
    link = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and not (a[4] and b[4])
            and 30 + 30 - 2 * len({*a[5]} & {*b[5]}) <= 400 // 9}
    assert link and link <= pairs and all(x // 100 == y // 100 for x, y in pairs)
    assert not [line for plan in plans for line in plan.splitlines() if "Join" in line and " t#" in line.replace("(", " ")]
    assert len(plans) <= 7  # before: 12, each a job of several stages whose broadcasts the driver holds


def test_a_round_of_components_joins_twice(spark, monkeypatch):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (5, 5), (40, 41), (41, 40), (40, 41)] + [(k, k + 1) for k in range(100, 140)]
    plans, saved = [], common.saved
    monkeypatch.setattr(common, "saved", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or saved(df, *a))
    found = common.components(spark.createDataFrame(edges, "a long, b long"))
    want = {n: 1 for n in (1, 2, 3)} | {n: 5 for n in range(5, 10)} | {40: 40, 41: 40} | {n: 100 for n in range(100, 141)}
    assert {r.node: r.component for r in found.collect()} == want and found.count() == len(want)
    assert max(plan.count("Join Inner") for plan in plans) == 2  # before: 3
    none = common.components(spark.createDataFrame([], "a long, b long"))
    assert none.count() == 0
