import random

import pytest

from caseweave import schemas
from caseweave.sources import csvranges, tables as S

PIECES = ["plain words", ",", '"', '""', "\n", "\r\n", "\n\n", "é ü 漢", ' "quoted" ', "a,b", "'", "\\", "x" * 300, "#"]


@pytest.fixture
def ranges(spark):
    """ranges(bytes): the size of a range until the test ends."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}

    def set_(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")
    yield set_
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def messages(n, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 6))) or None for _ in range(n)]
    return [(i, f"u{i % 7}", i % 2 == 0, "Tue Oct 31 22:08:27 +0000 2017", t, str(i + 1) if i % 3 else None, float(i - 1) if i else None) for i, t in enumerate(texts)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [40, 333, 1 << 20])
def test_equals_the_reader_of_whole_files(spark, tmp_path, ranges, size):
    """Borders of ranges fall anywhere: inside texts, between doubled quotes, inside line breaks."""
    out = str(tmp_path / "csv")
    for part in range(2):
        spark.createDataFrame(messages(120, part), schemas.TWEETS).coalesce(1).write.mode("append").option("header", True).option("escape", '"').csv(out)
    want = rows(S.read_tweets(spark, out))
    assert len(want) == 240 and any("\n" in (r[4] or "") for r in want)
    ranges(size)
    got = S.read_tweets_ranges(spark, out)
    assert rows(got) == want and got.schema == S.read_tweets(spark, out).schema
    tasks = csvranges._lines(spark, out).rdd.getNumPartitions()
    assert tasks == 1 if size > 100_000 else tasks > 20


def test_one_text_over_many_ranges_and_other_files(spark, tmp_path, ranges):
    ranges(64)
    header = ",".join(schemas.TWEETS.fieldNames())
    long = "line one\n\n, " * 100 + 'he said ""yes""'
    (tmp_path / "a.csv").write_text(f'{header}\r\n1,u,True,t,"{long}",,\r\n\r\n2,u,False,t,in "the" middle,3,1.0\r\n', newline="")
    (tmp_path / "b.csv").write_text(header + "\n")
    (tmp_path / "c.csv").write_text(f'"{header.replace(",", chr(34) + "," + chr(34))}"\nx,u,maybe,t,no number,,\n3,u,True,t,"open to the end')
    got = {r["text"]: r for r in S.read_tweets_ranges(spark, str(tmp_path)).collect()}
    assert set(got) == {long.replace('""', '"'), 'in "the" middle', "no number", "open to the end"} or set(got) == {
        long.replace('""', '"'), 'in "the" middle', "no number", '"open to the end'}
    assert got['in "the" middle']["in_response_to_tweet_id"] == 1.0 and got["no number"]["tweet_id"] is None
    assert S.read_tweets_ranges(spark, str(tmp_path / "b.csv")).count() == 0


def test_state_after():
    cases = [("a,b", False, False), ('"a,b', False, True), ('"a""', False, True), ('"a"""', False, False), ('x"y', False, False),
             ('a,"b","c', False, True), ('","b', True, True), ('", "b', True, False), ('end",x', True, False), ('""still', True, True), ('end","', True, True), ("", True, True), ('"', True, False)]
    assert [csvranges.state_after(line, inside) for line, inside, _ in cases] == [want for _, _, want in cases]
