"""Property: the Spark last-wins merge equals a plain-Python reference on
random batches (null keys, duplicates inside a batch, several batches)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varzea.operators.upsert import upsert

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.integers(-50, 50))
BATCH = st.lists(ROW, max_size=12)


def reference(batches):
    best = {}
    for b, rows in enumerate(batches):
        for k, pos, v in rows:
            cand = ((b, pos), v)
            if k not in best or cand > best[k]:
                best[k] = cand
    return {(k, v) for k, (_, v) in best.items()}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(BATCH, min_size=1, max_size=3))
def test_upsert_matches_reference(spark, batches):
    frames = []
    for b, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k int, pos int, v int")
        frames.append(df.withColumn("_seq", F.struct(F.lit(b).alias("b"), F.col("pos").alias("p"))).drop("pos"))
    expected = reference(batches)
    # all batches in one merge
    allb = frames[0]
    for f in frames[1:]:
        allb = allb.unionByName(f)
    assert {(r.k, r.v) for r in upsert(None, allb, ["k"]).collect()} == expected
    # batch after batch: the stored rows carry a sequence below every new batch
    stored = upsert(None, frames[0], ["k"])
    for f in frames[1:]:
        old = stored.withColumn("_seq", F.struct(F.lit(-1).alias("b"), F.lit(0).alias("p")))
        stored = upsert(old, f, ["k"])
    assert {(r.k, r.v) for r in stored.collect()} == expected
