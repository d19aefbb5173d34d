"""Spelling variants: words one edit apart, found by the rotations of a permuterm index, and the form each variant stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import in_files, materialize, measured, text_of

LETTERS = "A-Za-zÀ-ÿ"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LONG = 64  # longer rotations are compared by their SHA-256, so that a long word's do not grow with its square


def lowered(word: Column, accented: Column) -> Column:
    """Only A-Z in lower case; `accented` tells whether an accented capital may stand in the word."""
    return F.when(accented, F.translate(word, CAPITALS, CAPITALS.lower())).otherwise(F.lower(word))


def with_slips(word: Column, doc_id: Column, every: int) -> Column:
    """The word, without one letter where `every` divides the crc32 of `<doc_id>:<word>`: slips that can be checked."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = (h % F.length(word)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def word_counts(docs: DataFrame, min_length: int = 6, min_count: int = 5, slips: int | None = None) -> DataFrame:
    """word, n: runs of letters of at least `min_length` code points that occur `min_count` times or more in all texts.

    Counted where the texts are read, so a frequent word crosses the network once per task. Null texts have no words.
    """
    # A shorter run cannot become a word, and a run of letters this long is matched whole.
    found = F.regexp_extract_all(text_of(), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    texts = docs.select("doc_id", text_of().rlike("[À-Þ]").alias("accented"), found.alias("runs"))  # each text is searched once
    runs = texts.select("doc_id", "accented", F.explode("runs").alias("run"))
    words = runs.select("doc_id", lowered(F.col("run"), F.col("accented")).alias("word"))
    if slips:
        words = words.select(with_slips(F.col("word"), F.col("doc_id"), slips).alias("word"))
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """key, word, n, whole, first: the rotations of `word$`.

    A rotation brings one letter to the end and is cut before it, so its key skips that letter: words with one key differ by a
    replacement there. A word of one letter less has that key as a whole rotation: between the two stands an insertion.
    `first` marks a letter unlike the one before it; in a run of equal letters only its deletion counts.
    """
    size, at = F.length("word"), F.col("at")
    spread = words.select("word", "n", F.explode(F.sequence(F.lit(0), 2 * size)).alias("at"))
    spread = spread.select("word", "n", (at > size).alias("whole"), F.when(at > size, at - size).otherwise(at).alias("at"))
    # at = 0 is a whole rotation (`word$`); 1..size skip the letter at that place; above, whole rotations by 1..size letters
    spread = spread.withColumn("whole", F.col("whole") | (at == 0))
    ahead = F.when(F.col("whole"), at).otherwise(at - 1)
    key = F.concat(F.substring(F.col("word"), at + 1, size), F.lit("$"), F.substring(F.col("word"), F.lit(1), ahead))
    same = (at > 1) & (F.substring(F.col("word"), at, F.lit(1)) == F.substring(F.col("word"), at - 1, F.lit(1)))
    return spread.select(F.when(size > LONG, F.sha2(key, 256)).when((size == LONG) & F.col("whole"), F.sha2(key, 256)).otherwise(key).alias("key"),
                         "word", "n", "whole", (~F.col("whole") & ~same).alias("first"))


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, best (less: the negated count, other): how many words are one edit away, and the most frequent of them.

    Rotations with one key are sorted together. A group holds one word for each letter of the alphabet at most, and one shorter word; each
    member sees the others by the group's counts and its first two words, so no pairs are made. A replacement is met in one group,
    an insertion in one for each letter of a run and counted at its first.
    """
    member = F.struct((-F.col("n")).alias("less"), F.col("word").alias("other"), "whole", "first")
    groups = rotations(words).groupBy("key").agg(F.sort_array(F.collect_list(member)).alias("m")).filter(F.size("m") > 1)
    groups = groups.select("m", F.size(F.filter("m", lambda x: ~x["whole"])).alias("skips"), F.size(F.filter("m", lambda x: x["first"])).alias("firsts"),
                           F.exists("m", lambda x: x["whole"]).alias("shorter"), F.explode("m").alias("x"))
    others = F.when(F.col("x.whole"), F.col("firsts")).otherwise(F.col("skips") - 1 + (F.col("shorter") & F.col("x.first")).cast("int"))
    best = F.when(F.col("x.other") == F.col("m")[0]["other"], F.col("m")[1]).otherwise(F.col("m")[0])
    seen = groups.select(F.col("x.other").alias("word"), others.alias("others"), F.struct(best["less"].alias("less"), best["other"].alias("other")).alias("best"))
    return seen.groupBy("word").agg(F.sum("others").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, rows: int) -> DataFrame:
    """word, root: the last form that (word, form) links lead to. Links lead to larger counts, so there are no circles;
    each round doubles the links that a row has followed."""
    links = materialize(in_files(forms.select("word", F.col("form").alias("root")), rows), "links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        links, seen = measured(in_files(followed, rows), "links", moved=F.count_if("moved"))
        links = links.drop("moved")
        if not seen["moved"]:
            return links


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table (word, n) of different words.

    n_near counts the words that differ by one inserted, deleted or replaced code point. form is the most frequent of them
    (ties: the smallest in code-point order) if it occurs at least `ratio` (two or more) times as often as the word, else null;
    root is the last form that forms lead to, the word itself if it has none. Empty table: no rows.
    """
    words, seen = measured(words, "words", rows=F.count(F.lit(1)))
    found = words.join(neighbours(words), "word", "left")
    n = -F.col("best.less")
    better = n >= ratio * F.col("n")
    found = found.select("word", F.when(better, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(better, n).alias("form_n"))
    found = materialize(in_files(found, seen["rows"]), "forms")
    linked = roots(found.filter("form is not null"), seen["rows"])
    return found.join(linked, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
