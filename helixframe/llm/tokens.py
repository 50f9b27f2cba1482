"""Token counts through a digest cache."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, new_path, split_by, table

#: Most distinct words whose counts one Python worker remembers.
WORD_MEMO = 400_000
CACHE_SCHEMA = "content binary, tokenizer binary, n_tokens long"
#: White space of ASCII, which this tokenizer drops wherever it stands.
SPACE = re.compile("[\t-\r ]+")

_state: dict = {}


def tokenizer_digest(path: str) -> bytes:
    """Names a tokenizer's version: the hash of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).digest()


def drops_space(path: str) -> bool:
    """Whether the tokenizer gives no token for ASCII white space and joins nothing across it."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    ids = lambda t: tok.encode(t, add_special_tokens=False).ids
    spaces = ["\t", "\n", "\x0b", "\x0c", "\r", " "]
    pieces = ["ka", "Lo,", "7", "(x)", "é"]
    return all(
        ids(a + gap + b) == ids(a) + ids(b) and ids(gap + a + gap) == ids(a) and not ids(gap)
        for gap in [*spaces, "  ", "\r\n", "\n\n\t "] for a in pieces for b in pieces
    )


def _counter(path: str):
    """Counts by white-space-separated piece, remembered between batches of a worker.

    The tokenizer's own pre-tokenizer never joins across white space and its special strings hold
    none, so a text's count is the sum over its pieces.
    """
    if _state.get("path") != path:
        from tokenizers import Tokenizer

        _state.update(path=path, tokenizer=Tokenizer.from_file(path), memo={})
    tok, memo = _state["tokenizer"], _state["memo"]

    def count(texts: list[str]) -> list[int]:
        split = [SPACE.split(t) for t in texts]
        new = {w for words in split for w in words}
        new.difference_update(memo)
        if len(memo) + len(new) > WORD_MEMO:
            memo.clear()
            new = {w for words in split for w in words}
        todo = list(new)
        for i in range(0, len(todo), 4096):
            part = todo[i : i + 4096]
            memo.update(zip(part, map(len, tok.encode_batch_fast(part, add_special_tokens=False)), strict=True))
        return [sum(map(memo.__getitem__, words)) for words in split]

    return count


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = _counter(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            n: list[int] = []
            at = 0
            while at < len(texts):  # about 1 MB at a time, for the memo's sake
                end, size = at, 0
                while end < len(texts) and (size < 1 << 20 or end == at):
                    size += len(texts[end])
                    end += 1
                n += count(texts[at:end])
                at = end
            yield pa.RecordBatch.from_arrays([b.column("content"), pa.array(n, pa.int64())], ["content", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_dir: str | None = None, limit: int = 2048) -> DataFrame:
    """Tokens of every whole text: ``docs`` with n_bytes, n_tokens, over_limit.

    Texts are normalised (runs of ASCII white space become one space, which cannot change a count
    of a tokenizer that drops white space), digested with SHA-256, and looked up under (content
    digest, tokenizer digest) in the cache table at ``cache_dir``. Each distinct content that the
    cache lacks is encoded once; its count is appended to the cache, which later calls find there.
    Without ``cache_dir`` the call starts a cache of its own. Once the cache holds counts of this
    tokenizer, missing digests are named first, and of the texts only theirs (told by a bit map of
    fixed size) are moved.

    Needs columns doc_id and text; others are left out. A null text counts as empty: 0 tokens, 0
    bytes. Repeated rows each give a row. An empty table gives none. The tokenizer must be one
    that drops white space; ``count_tokens`` refuses others.
    """
    spark = docs.sparkSession
    if not drops_space(tokenizer_path):
        raise ValueError("the tokenizer must drop white space")
    bounded_batches(spark)
    cache_dir = cache_dir or new_path(spark, "token_cache")
    version = F.lit(tokenizer_digest(tokenizer_path))
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(F.regexp_replace(text, r"[\t-\r ]+", " "), 256)).alias("content"),
    )
    _make_cache(spark, cache_dir)
    cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).where(F.col("tokenizer") == version)
    known = cache.select("content")
    texts = docs.select(F.unhex(F.sha2(F.regexp_replace(text, r"[\t-\r ]+", " "), 256)).alias("content"), text.alias("text"))
    if known.limit(1).count():
        lacking = seen.select("content").distinct().join(known, "content", "left_anti")
        texts = split_by(texts, lacking, ["content"])[1]
    misses = (
        texts.groupBy("content")
        .agg(F.first("text").alias("text"))
        .join(known, "content", "left_anti")
    )
    (
        misses.mapInArrow(_encode(tokenizer_path), "content binary, n_tokens long")
        .select("content", version.alias("tokenizer"), "n_tokens")
        .write.mode("append")
        .parquet(cache_dir)
    )
    cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).where(F.col("tokenizer") == version)
    # two writers at once may both have appended a content: equal rows, of which one is taken
    counts = cache.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return seen.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _make_cache(spark: SparkSession, cache_dir: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(cache_dir)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("ignore").parquet(cache_dir)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
