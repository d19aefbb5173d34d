"""The given test tables seen as messages, with an intent dictionary that fits their invented text.

`messages` turns the conversations table into support messages, rule by rule. The stand-in
classifier gives every intent a probability from its keyword hits, so a whole triage run can be
checked in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import classify, golden as G, labels, retrieve
from ..session import materialize
from .ingest import Corpus, ingest

BRAND = "BrandCare"
HANDLE = "@BrandCare"

# Intent, display name, risk, action, example sentences
TAXONOMY = [
    ("alpha_power", "Alpha Power", "low", "AUTO_HANDLE", ["Erin said the thing ended there", "Thentin reand thing"]),
    ("beta_update", "Beta Update", "low", "AUTO_HANDLE", ["Then thor edthe again", "Erthe then"]),
    ("gamma_account", "Gamma Account", "high", "ESCALATE_TO_HUMAN", ["Than que ention", "Elle than that"]),
    ("delta_billing", "Delta Billing", "high", "ESCALATE_TO_HUMAN", ["Ther und einer", "Schen ther with"]),
    ("epsilon_damage", "Epsilon Damage", "high", "ESCALATE_TO_HUMAN", ["Thin des onent", "Aient thin"]),
    ("zeta_network", "Zeta Network", "low", "AUTO_HANDLE", ["Tion die ereun", "Ungen tion"]),
    ("eta_audio", "Eta Audio", "low", "AUTO_HANDLE", ["Ering der heit", "Keiten ering"]),
    ("theta_storage", "Theta Storage", "low", "AUTO_HANDLE", ["Blethe pour ment", "Ement pour"]),
    ("iota_freeze", "Iota Freeze", "low", "AUTO_HANDLE", ["Thou les ering", "Ouren thou"]),
    ("kappa_general", "Kappa General", "low", "AUTO_HANDLE", ["From nicht lich", "Lichen from"]),
]
KEYWORDS = [
    ("alpha_power", ["thing", "erin"]),
    ("beta_update", ["then", "thor"]),
    ("gamma_account", ["than", "que"]),
    ("delta_billing", ["ther", "und"]),
    ("epsilon_damage", ["thin", "des"]),
    ("zeta_network", ["tion", "die"]),
    ("eta_audio", ["ing", "der"]),
    ("theta_storage", ["ble", "pour"]),
    ("iota_freeze", ["thou", "les"]),
    ("kappa_general", ["from", "nicht"]),
]
DEFAULT = "kappa_general"
RICH_WORDS = ["the", "und", "la", "der", "el"]
HIT_SMOOTHING = 0.05

# Sizes of the evaluation set that suit the small tables
PER_INTENT, AMBIGUOUS, TARGET = 3, 5, 40
SMALL_SET = (1, 2, 10)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def message_id(turn: Column) -> Column:
    """conv_id * 100 + turn + 1 below 100 turns; later turns of a conversation have ids from 2^52 on, with 24 bits for the turn.

    So no two messages share an id, ids rise with the turn, and all are exact as doubles, as parent ids are. A message
    that has no such id ends the run: one of a turn of 2^24 or more, or, in a conversation of over 100 turns, of a conversation of 2^28 or more.
    """
    conv, late = F.col("conv_id").cast("long"), turn.cast("long") - 100
    fits = (conv >= 0) & (conv < 1 << 28) & (late < 1 << 24)
    return (F.when(late < 0, conv * 100 + turn + 1).when(fits, F.lit(1 << 52) + conv * (1 << 24) + late)
            .when(late.isNotNull() & conv.isNotNull(), F.raise_error(F.lit("conv_id or turn is too large for a message id")).cast("long")))


def as_messages(conversations: DataFrame, many_brands: bool = False) -> DataFrame:
    """Conversation rows as messages; works on batch and streaming tables."""
    c = F.col
    brand = F.concat(F.lit("Brand"), (c("conv_id") % 5).cast("string")) if many_brands else F.lit(BRAND)
    customer = F.concat(F.lit("u"), c("conv_id").cast("string"))
    is_user, is_agent = c("role") == "user", c("role") == "assistant"
    id_ = message_id(c("turn"))
    minutes = F.timestamp_seconds(F.lit(1509487707) + (c("conv_id") * 100 + c("turn") + 1) * 60)
    return conversations.select(
        id_.alias("tweet_id"),
        F.when(is_agent, brand).when(is_user, customer).otherwise("SystemBot").alias("author_id"),
        is_user.alias("inbound"),
        F.date_format(minutes, "EEE MMM dd HH:mm:ss Z yyyy").alias("created_at"),
        F.when(is_user, F.concat(F.lit("@"), brand, F.lit(" "), c("text")))
        .when(is_agent, F.concat(F.lit("@"), customer, F.lit(" "), c("text"))).otherwise(c("text")).alias("text"),
        F.when(is_user, message_id(c("turn") + 1).cast("string")).alias("response_tweet_id"),
        F.when(c("turn") > 0, message_id(c("turn") - 1)).cast("double").alias("in_response_to_tweet_id"))


def messages(spark: SparkSession, sf_dir: str, many_brands: bool = False) -> DataFrame:
    return as_messages(table(spark, sf_dir, "conversations"), many_brands)


def doubled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message twice, the second time with a changed text, to exercise deduplication."""
    once = messages(spark, sf_dir)
    return once.unionByName(once.withColumn("text", F.concat("text", F.lit(" (again)"))))


def taxonomy(spark: SparkSession) -> DataFrame:
    return labels.taxonomy_dimension(spark, TAXONOMY)


_tables: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """Build a derived table once per application, as a stored index would be."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        _tables[key] = make()
    return _tables[key]


def forget() -> None:
    """Drop what was built, so that the next query starts from the given tables."""
    _tables.clear()


def corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    return _once(spark, sf_dir, "corpus", lambda: ingest(messages(spark, sf_dir), BRAND))


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer message with its cleaned text."""
    from ..functions import text as X

    return messages(spark, sf_dir).filter("inbound").select(
        "tweet_id", "text", X.clean_customer_text(F.col("text"), HANDLE).alias("cleaned"))


def golden(spark: SparkSession, sf_dir: str, sizes=(PER_INTENT, AMBIGUOUS, TARGET)) -> DataFrame:
    def make():
        return materialize(G.golden_set(corpus(spark, sf_dir).threads, taxonomy(spark), *sizes,
                                        dictionary=KEYWORDS, default_intent=DEFAULT), "golden")
    return _once(spark, sf_dir, f"golden{sizes}", make)


def cases(spark: SparkSession, sf_dir: str, sizes=SMALL_SET) -> DataFrame:
    return retrieve.build_cases(corpus(spark, sf_dir).threads, golden(spark, sf_dir, sizes), KEYWORDS,
                                default=DEFAULT)


def index(spark: SparkSession, sf_dir: str, sizes=SMALL_SET) -> retrieve.CaseIndex:
    return _once(spark, sf_dir, f"index{sizes}", lambda: retrieve.build_index(cases(spark, sf_dir, sizes)))


def rule_scores(df: DataFrame, text: str) -> DataFrame:
    """Probabilities from keyword hits: (hits + s) / (all hits + s * intents)."""
    hits = df.withColumns({f"_h{i}": h for i, h in enumerate(labels.multi_keyword_hits(F.col(text), KEYWORDS))})
    columns = [f"_h{i}" for i in range(len(KEYWORDS))]
    total = sum((F.col(h) for h in columns), F.lit(0)) + F.lit(HIT_SMOOTHING * len(KEYWORDS))
    scores = F.array(*[F.struct(((F.col(h) + F.lit(HIT_SMOOTHING)) / total).alias("probability"),
                                F.lit(name).alias("intent")) for h, (name, _) in zip(columns, KEYWORDS)])
    return hits.withColumn("scores", scores).drop(*columns)


def rule_classifier(spark: SparkSession):
    dims = taxonomy(spark)
    return lambda df, doc, text: labels.taxonomy_join(
        classify.predict_top2(rule_scores(df, text)), dims).drop("scores")


def training_rows(spark: SparkSession, sf_dir: str, n: int | None) -> DataFrame:
    """Single-match customer messages whose conversations are not in the evaluation set."""
    turns = corpus(spark, sf_dir).turns.filter("role = 'customer'").select(
        "tweet_id", F.concat(F.lit("conv_"), F.col("root_tweet_id").cast("string")).alias("conversation_id"),
        F.col("cleaned_text"))
    return labels.training_sample(turns, golden(spark, sf_dir, SMALL_SET), n, KEYWORDS, "tweet_id", "cleaned_text")
