"""Token counts with a cache keyed by content and tokenizer digests.

A text's key is the SHA-256 of its normalised content; the tokenizer's is the SHA-256 of its file.  Stored counts are
joined to the keys, every distinct text without a count is encoded once, and its count is appended to the cache.

Normalised content is the text itself with null as the empty text: the libraries count each other difference, so any
wider normalisation could give a wrong count.  Repeated texts share one count.  Empty tables give no row.  A cache
with repeated entries (two runs that appended the same texts) is read as if each were there once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, keep, utf8
from millrace.session import path_exists

_CACHE = pa.schema([("digest", pa.binary()), ("version", pa.string()), ("n_tokens", pa.int64())])
_CACHE_DDL = "digest binary, version string, n_tokens long"


def file_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _counter(path: str):
    """Function from a list of UTF-8 texts to their numbers of ids, by the library the file belongs to."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in library.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return lambda texts: [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def _encoder(path: str, version: str):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            found = [count([t.decode("utf-8", "replace")])[0] for t in utf8(batch.column(1))]
            columns = [batch.column(0).cast(pa.binary()), pa.array([version] * len(found), pa.string()), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=_CACHE)

    return counts


def read_cache(spark, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, each digest once."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    stored = spark.read.schema(_CACHE_DDL).parquet(cache).where(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; new texts' counts are in ``cache`` afterwards.

    Texts move once, to bring equal digests together; copies are dropped before that exchange within each task, so
    a text that a third of the rows share is one row per task.  The last join moves digests and numbers only.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    version = file_version(tokenizer)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    missing = keyed.select("digest", "text").dropDuplicates(["digest"])
    missing = missing.join(read_cache(spark, cache, version), "digest", "left_anti")
    missing.mapInArrow(_encoder(tokenizer, version), _CACHE_DDL).write.mode("append").parquet(cache)
    sizes = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    # Written once, so that both sides of the join are plain exchanges and Spark can split a digest that many rows share.
    counts = keep(read_cache(spark, cache, version), "counts")
    return sizes.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
