"""A corpus pipeline of five stages: good texts, one of each group of near-copies, no personal data, mixed by
source, as token ids.

Each stage takes (session, documents, folder of tables) and returns the documents it keeps, with the columns of
``documents``; the last one returns ids. ``run`` writes each stage's result to the shared folder and
reads it again, so a lost executor never reaches back beyond one stage.

Empty tables pass through all stages. Ids may be missing or repeated: rows are told apart by their place and content.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm import bpe, mixing, near_dup, pii, quality
from paceline.llm.tables import fresh, stored, text_of
from paceline.session import prepare

RANKS = "byte_bpe_multi_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.learn(docs.select("doc_id", "text"), labels)
    mark = fresh(docs, "score")
    return quality.score(docs, model, name=mark).filter(F.col(mark) >= quality.THRESHOLD).drop(mark)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: shingles of five words, a similarity of 0.8 or more.

    Rows are compared by their texts, whatever their ids: a repeated or missing id links nothing and saves nothing.
    Of a group the row with the smallest id stays (rows without one come last), of several with that id the first
    in the order of the files. Texts without words are like nothing else and stay.
    """
    prepare(spark)
    # ``docs`` are files, so a row has the same number each time it is read.
    row = fresh(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = near_dup.near_duplicates(numbered, words=5, percent=80, id=row)
    of = stored(found.select("id", "component_id"), "copies")
    groups = of.filter("id <> component_id").select(F.col("component_id").alias("group")).distinct()
    members = of.join(groups, F.col("component_id") == F.col("group"), "left_semi")
    ids = numbered.select(F.col(row).alias("at"), F.col("doc_id").alias("doc"))
    ranked = members.join(ids, F.col("id") == F.col("at"))
    stays = ranked.groupBy("component_id").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "id")).alias("best")).select(F.col("best.id").alias("kept"))
    gone = members.join(stays, F.col("id") == F.col("kept"), "left_anti").select(F.col("id").alias(fresh(numbered, "gone")))
    return numbered.join(gone, F.col(row) == F.col(gone.columns[0]), "left_anti").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by pseudonyms."""
    prepare(spark)
    return pii.pseudonymise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: once for each pass over a source that takes at least half of
    a document's words (only the last document of a source is ever taken in part). All columns come back as they were."""
    prepare(spark)
    # Rows alike in all columns have one key; as many of them come back as the mix takes.
    null = F.lit("\0")
    parts = [F.md5(F.coalesce(F.col(f"`{c}`").cast("string"), null)) for c in docs.columns]
    key, of, many = (fresh(docs, name) for name in ("key", "key_of", "many"))
    named = docs.withColumn(key, F.concat_ws("|", *parts))
    placed, pieces = mixing.mix(named.select(F.col(key).alias("key"), "source", "text"), keep=["key"])
    passes = pieces.groupBy("place", "start", "size", "copy").agg(F.sum("words").alias("words")).filter("words * 2 >= size")
    taken = passes.join(placed.select("place", "start", "size", "key"), ["place", "start", "size"]).groupBy("key").agg(F.count("*").alias("n"))
    # Texts without words have nothing to mix and stay as they are.
    wordless = placed.filter("size = 0").groupBy("key").agg(F.count("*").alias("n"))
    times = taken.union(wordless).select(F.col("key").alias(of), F.col("n").cast("int").alias(many))
    single = named.groupBy(key).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("doc"))
    chosen = single.join(times, F.col(key) == F.col(of)).withColumn(many, F.explode(F.sequence(F.lit(1), F.col(many))))
    return chosen.select("doc.*")


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether decoding them gives its text."""
    prepare(spark)
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    named = docs.select("doc_id", "source", "text", F.sha2(text_of("text"), 256).alias("digest"))
    encoded = bpe.encode(named, ranks, public_tokenizers.PATTERN, keep=["doc_id", "source", "digest"])
    return bpe.decode(encoded, ranks).select(
        "doc_id", "source", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"))


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", without_near_copies),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokenised),
]

# A trained network and a keyed permutation are not SQL; tests check the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs
