import json

from pyspark.sql import functions as F

from caseweave.operators import threads as D
from caseweave.plans import bindings as T, registry as Q
from caseweave.session import lookup_join
from caseweave.sources import tables as S
from caseweave.streaming import streams

SF = "/root/testdata/sf0.001"


def test_csv_round_trip(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n'
                      '2,AppleSupport,False,Tue Oct 31 22:10:47 +0000 2017,"line one\nline ""two"", end",3,1.0\n'
                      '1,115712,True,Tue Oct 31 22:08:27 +0000 2017,hello,2,\n', encoding="utf-8")
    df = S.read_tweets(spark, str(source))
    rows = sorted(df.collect())
    assert [r.tweet_id for r in rows] == [1, 2] and rows[1].text == 'line one\nline "two", end'
    assert rows[0].in_response_to_tweet_id is None and rows[1].in_response_to_tweet_id == 1.0 and rows[0].inbound
    for fmt in ("csv", "parquet"):
        out = str(tmp_path / fmt)
        S.write_tweets(df, out, fmt)
        back = S.read_tweets(spark, out) if fmt == "csv" else spark.read.parquet(out)
        assert sorted(back.collect()) == rows


def test_threads_round_trip(spark, tmp_path):
    corpus = T.corpus(spark, SF)
    nested = D.nested_threads(corpus.turns, corpus.threads)
    S.write_threads(nested, str(tmp_path / "t"))
    back = S.read_threads(spark, str(tmp_path / "t"))
    assert sorted(map(str, back.collect())) == sorted(map(str, nested.select(back.columns).collect()))
    assert back.filter(F.size("turns") != F.col("turn_count")).count() == 0


def test_held_out_golden_taxonomy(spark, tmp_path):
    path = tmp_path / "ids.json"
    path.write_text(json.dumps(["conv_1", "conv_2"], indent=2))
    assert sorted(r[0] for r in S.read_held_out(spark, str(path)).collect()) == ["conv_1", "conv_2"]
    golden = T.golden(spark, SF, T.SMALL_SET)
    S.write_golden(golden, str(tmp_path / "g"))
    assert sorted(S.read_golden(spark, str(tmp_path / "g")).collect()) == sorted(golden.collect())
    S.write_held_out(golden, str(tmp_path / "h"))
    assert S.read_held_out(spark, str(tmp_path / "h")).count() == golden.count()
    intents = {"intents": [{"name": n, "display_name": dn, "risk_level": r, "default_action": a, "examples": ex}
                           for n, dn, r, a, ex in T.TAXONOMY]}
    (tmp_path / "intents.json").write_text(json.dumps(intents))
    assert S.read_taxonomy(spark, str(tmp_path / "intents.json")).collect() == T.taxonomy(spark).collect()


def test_result_record(spark, tmp_path):
    S.write_record(spark.range(1).select(F.struct(F.lit(1).alias("a")).alias("part")), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().part.a == 1


def test_lookup_join_both_ways(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else "cold") for i in range(60)], "i int, k string")
    side = spark.createDataFrame([("hot", 1), ("other", 2)], "k string, v int")
    for how in ("inner", "left"):
        small = sorted(map(str, lookup_join(left, side, "k", how, small=True).select("i", "k", "v").collect()))
        salted = sorted(map(str, lookup_join(left, side, "k", how, small=False).select("i", "k", "v").collect()))
        assert small == salted


def test_stream_equals_batch(spark):
    stream = sorted(map(tuple, Q.stream_triage(spark, SF).collect()))
    batch = sorted(map(tuple, Q.triage_rules(spark, SF).collect()))
    assert stream == batch and len(batch) > 0
    assert Q.stream_clean_label(spark, SF).count() == T.messages(spark, SF).count()


def test_streams_over_folders_of_part_files(spark, tmp_path):
    """Tables that are folders of part files give the same rows as tables that are files."""
    for name in ("conversations", "events"):
        T.table(spark, SF, name).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for query in (Q.stream_clean_label, Q.stream_dedup, Q.stream_triage, Q.stream_escalation_windows):
        rows = [sorted(map(str, query(spark, folder).collect())) for folder in (str(tmp_path), SF)]
        assert rows[0] == rows[1] and rows[0], query.__name__


def test_stream_dedup_over_batches(spark, tmp_path):
    events = T.table(spark, SF, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    folder = str(tmp_path / "in")
    for part in (events, events.filter("event_id % 2 = 0")):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    streams.run_to_table(streams.dedup(stream, "event_id", "ts", "30 days"), str(tmp_path / "out"),
                         str(tmp_path / "log")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_entry(spark):
    import __spark_entry__ as entry

    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and len(names) >= 100
    assert entry.entry(spark).count() == T.messages(spark, SF).filter("inbound").count()
