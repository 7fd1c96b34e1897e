"""Incremental (streaming) loads agree with one batch pass over all rows."""

import os

from quietude.operators import stats
from quietude.sources import adapter
from quietude.sources.tables import table
from quietude.streaming import incremental as S
from tests.conftest import SF_SMALL


def test_streamed_partials_merge_to_batch_result(spark, tmp_out):
    r = adapter.readings(table(spark, SF_SMALL, "events"), keep_id=False)
    src = os.path.join(tmp_out, "incoming")
    # two arriving drops of files
    r.filter("day_of_week < 3").write.parquet(os.path.join(src, "a"))
    r.filter("day_of_week >= 3").write.parquet(os.path.join(src, "b"))
    stream = spark.readStream.schema(r.schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", "1").parquet(src)
    parts = os.path.join(tmp_out, "partials")
    q = S.moments_by_batch(stream, parts, os.path.join(tmp_out, "ckpt"))
    q.awaitTermination()
    got = {x["key"]: tuple(x[1:]) for x in S.merged_moments(spark, parts).collect()}
    want = {x["key"]: tuple(x[1:]) for x in stats.noise_grouping_sets(r).collect()}
    assert got.keys() == want.keys()
    for k, (n, mean, std, lo, hi) in want.items():
        gn, gmean, gstd, glo, ghi = got[k]
        assert (gn, glo, ghi) == (n, lo, hi)
        assert abs(gmean - mean) <= 0.011 and abs(gstd - std) <= 0.011
    assert spark.read.parquet(parts).select("batch_id").distinct().count() > 1
    compacted = os.path.join(tmp_out, "compacted")
    S.compact_partials(spark, parts, compacted)
    again = {x["key"]: tuple(x[1:]) for x in S.merged_moments(spark, compacted).collect()}
    assert again.keys() == got.keys()
    for k, v in got.items():
        assert again[k][0] == v[0] and again[k][3:] == v[3:]
        assert abs(again[k][1] - v[1]) <= 0.011 and abs(again[k][2] - v[2]) <= 0.011
    assert spark.read.parquet(compacted).select("batch_id").distinct().count() == 1


def test_append_stream_exactly_once(spark, tmp_out):
    r = adapter.readings(table(spark, SF_SMALL, "events"), keep_id=False)
    src = os.path.join(tmp_out, "incoming")
    r.write.parquet(src)
    out, ck = os.path.join(tmp_out, "table"), os.path.join(tmp_out, "ck")
    S.append_readings(S.read_readings_stream(spark, src), out, ck).awaitTermination()
    # a rerun with the same checkpoint finds nothing new
    S.append_readings(S.read_readings_stream(spark, src), out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == r.count()
