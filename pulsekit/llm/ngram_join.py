"""Operator 3: n-gram Jaccard join of documents by MinHash banding.

Texts are compared as sets of five-word shingles; a pair links at a Jaccard
similarity of 0.8 or more. Band and row counts follow from the target recall
(``neardup.choose_bands``), buckets are shuffled by band hash and every
candidate is verified on the whole shingle sets.

Defined results: null texts and texts without a word link to nothing and form a
class of their own; a text of one to four words has one shingle of all its
words; equal texts are copies of each other (each a link); repeated rows count
as copies; the class id is the least doc_id, null first; a very long text is one row of
one task, in memory proportional to it; a null doc_id takes part and comes back null;
an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import neardup as ND
from pulsekit.llm import textarrays as TA
from pulsekit.llm.storage import saved

_GRAM_FIELDS = "id long, grp long, size long, weight long, grams binary"


def _band_rows(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for c in TA.text_chunks(batch.column("text")):
                w = TA.words_of(c)
                h, owner = ND.band_hashes(*TA.ngrams(TA.word_hashes(c, w), w.text, k, c.n), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.ravel()), pa.array(np.repeat(ids[c.lo:c.hi][owner], bands))], ["bucket", "id"])
    return run


def _gram_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in TA.text_chunks(batch.column("text")):
                w = TA.words_of(c)
                g, owner = TA.ngrams(TA.word_hashes(c, w), w.text, k, c.n)
                cut = np.searchsorted(owner, np.arange(c.n + 1))
                sets = [np.unique(g[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])]
                part = batch.slice(c.lo, c.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(x) for x in ("id", "grp", "size", "weight")] + [pa.array(sets, pa.binary())],
                    ["id", "grp", "size", "weight", "grams"])
    return run


def similarity_classes(spark: SparkSession, docs: DataFrame, threshold: float = ND.THRESHOLD,
                       k: int = ND.SHINGLE_WORDS, target_recall: float = ND.TARGET_RECALL) -> DataFrame:
    """One row per document: doc_id, id (text hash), class_id (least doc_id of its class), n_links."""
    bands, rows = ND.choose_bands(threshold, target_recall)
    texts = docs.select("doc_id", F.xxhash64("text").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    wordy = texts.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    copies = saved(spark, wordy.groupBy("id").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight")),
                   "copies")
    buckets = wordy.select("id", "text").mapInArrow(_band_rows(k, bands, rows), "bucket long, id long")
    groups = ND.candidate_groups(spark, buckets)
    # one row of each candidate text; the key holds doc_id so that copies spread over the partitions
    chosen = groups.join(copies, "id").withColumnRenamed("id", "cid")
    items = (
        wordy.join(chosen, (F.col("id") == F.col("cid")) & F.col("doc_id").eqNullSafe(F.col("rep")))
        .dropDuplicates(["cid", "rep"])
        .select("id", "grp", "size", "weight", "text").mapInArrow(_gram_sets(k), _GRAM_FIELDS)
    )
    classes = ND.verified_classes(spark, items, threshold)
    least = copies.join(classes, "id", "left").select(
        "id", "rep", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("comp", "id").alias("comp"))
    least = saved(spark, least, "classes")
    class_id = least.groupBy("comp").agg(F.min("rep").alias("class_id"))
    table = saved(spark, least.join(class_id, "comp").select(F.col("id").alias("kid"), "class_id", "n_links"),
                  "class-ids")
    empty = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.select("doc_id", F.when(empty, F.lit(None)).otherwise(F.xxhash64("text")).alias("id"))
    return keyed.join(table, F.col("id") == F.col("kid"), "left").select(
        "doc_id", "id", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one_per_class(spark: SparkSession, docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` with one document (least doc_id) of each class.

    Texts without a word are all kept. All columns of ``docs`` come back.
    """
    classes = similarity_classes(spark, docs, **kw).where("id is not null")
    winners = saved(spark, classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
                    .select(F.col("id").alias("wid"), F.col("doc_id").alias("wdoc")).distinct(), "winners")
    wordy = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # the whole row travels as one column, so that no name of it can clash
    rows = docs.where(wordy).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                    F.xxhash64("text").alias("id"), F.col("doc_id").alias("doc"))
    kept = (
        rows.join(winners, (F.col("id") == F.col("wid")) & F.col("doc").eqNullSafe(F.col("wdoc")))
        .dropDuplicates(["wid", "wdoc"]).select("row.*")
    )
    return kept.unionByName(docs.where(~wordy))
