"""Stream = batch: the same operators over a table split into files."""

import pytest

from shroud.operators import classify as C
from shroud.plans.protect import Control, Reader, protect
from shroud.registry.classification import q_stream_classify, q_stream_protect
from shroud.sources import metadata as md
from shroud.streaming.protect_stream import file_stream, run_aggregate, run_per_batch

SF = "/root/testdata/sf0.001"


def _split(spark, scratch, name, parts=4):
    df = spark.read.parquet(f"{SF}/{name}.parquet")
    src = f"{scratch}/src"
    df.repartition(parts).write.parquet(src)
    return df, src


def test_stream_protect_equals_batch(spark, scratch):
    events, src = _split(spark, scratch, "events")
    ents = spark.createDataFrame([("ops", "click", False), ("ops", "view", True)], md.ENTITLEMENTS)
    ctl = [Control(md.FILTER, "scope_filter", ("event_type",)), Control(md.MASK, "null_mask", ("value",))]
    stream = file_stream(spark, src, "*.parquet", events.schema, max_files=1)
    got = run_per_batch(stream, lambda b: protect(b, ctl, Reader("ops", ents)), f"{scratch}/out", f"{scratch}/ck")
    want = protect(events, ctl, Reader("ops", ents))
    assert sorted(map(tuple, got.select(*events.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 0


def test_stream_classify_equals_batch(spark, scratch):
    docs, src = _split(spark, scratch, "documents", 3)
    stream = file_stream(spark, src, "*.parquet", docs.schema, max_files=1)
    got = run_aggregate(C.classify(stream, "d", C.BUILTIN, ["text"]), f"{scratch}/out", f"{scratch}/ck")
    want = C.classify(docs, "d", C.BUILTIN, ["text"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_protect_directly_on_a_stream(spark, scratch):
    """A snapshot reader's protect() is stateless literal work, so it applies to a
    streaming DataFrame as it is, with any sink; the result equals the batch answer."""
    events, src = _split(spark, scratch, "events")
    ents = spark.createDataFrame([("ops", "error", False)], md.ENTITLEMENTS)
    ctl = [Control(md.FILTER, "scope_filter", ("event_type",)), Control(md.MASK, "null_mask", ("value",))]
    stream = protect(file_stream(spark, src, "*.parquet", events.schema, max_files=2), ctl, Reader("ops", ents))
    q = (stream.writeStream.format("parquet").option("path", f"{scratch}/direct")
         .option("checkpointLocation", f"{scratch}/direct_ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/direct")
    want = protect(events, ctl, Reader("ops", ents))
    assert sorted(map(tuple, got.select(*events.columns).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("files", [0, 3])
def test_streamed_tables_are_a_file_or_a_folder(spark, scratch, files):
    """0: documents.parquet and events.parquet are files; 3: folders of three files, as Spark writes them."""
    tables = {"documents": spark.createDataFrame([(i, t, "en", "web", 9) for i, t in enumerate(["a@b.org", "x", None, "ip 10.0.0.1"])],
                                                 "doc_id long, text string, lang string, source string, n_chars long"),
              "events": spark.createDataFrame([(i, None, i, "click" if i % 2 else "view", 1.5, "{}") for i in range(8)],
                                              "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
              "customer": spark.createDataFrame([("c", "s", 1.0)], "c_name string, c_mktsegment string, c_acctbal double")}
    for name, df in tables.items():
        if files:
            df.repartition(files).write.parquet(f"{scratch}/{name}.parquet")
        else:
            df.toPandas().to_parquet(f"{scratch}/{name}.parquet", coerce_timestamps="us")
    got = q_stream_classify(spark, scratch)
    want = C.classify(tables["documents"], "main.tpch.documents", C.BUILTIN, ["text"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.where("n_hits > 0").count() == 2
    assert sorted(r.event_id for r in q_stream_protect(spark, scratch).collect()) == [1, 3, 5, 7]
