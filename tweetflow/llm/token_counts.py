"""Token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.common import beside

# Texts encoded at once: their ids are held in memory.
BLOCK_CHARS = 1 << 21
# Digests a task remembers to pass over copies; a copy that comes later is encoded again.
REMEMBERED = 1 << 16
CACHE = "content string, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


@lru_cache(maxsize=2)
def _counter(path: str):
    """A function from texts to numbers of tokens, without added special tokens, truncation or padding."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: list(map(len, model.encode(texts, num_threads=1)))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(found.ids) for found in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _encode(path: str):
    """Counts of the texts, of copies in one task the first only."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen = _counter(path), OrderedDict()
        for batch in rows:
            counts, block, chars, new = [], [], 0, []
            for at, content in enumerate(batch.column("content").to_pylist()):
                known = content in seen
                seen[content] = None
                seen.move_to_end(content)
                if known:
                    continue
                if len(seen) > REMEMBERED:
                    seen.popitem(last=False)
                new.append(at)
                block.append(batch.column("content_text")[at].as_py())
                chars += len(block[-1])
                if chars > BLOCK_CHARS:
                    counts, block, chars = counts + count(block), [], 0
            counts += count(block) if block else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("content").take(pa.array(new, pa.int64())), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    return batches


def _stored(spark, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer version; two jobs may have stored the same one."""
    try:
        stored = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, model: str, cache: str, carry: list[str], limit: int = 4096) -> DataFrame:
    """The carried columns with n_bytes, n_tokens and over_limit of every row of docs (doc_id, text, ...).

    model: a file of the sentencepiece (.model) or tokenizers (.json) library, at the same path on every machine.
    cache: a folder all machines share. Counts are stored under (digest of the content, digest of the model's
    file). Content is the UTF-8 text as it is, null as the empty text; any further normalising would change counts.
    Of texts the cache does not have the rows of one id are chosen, however many ids hold them, from ids and digests alone;
    rows of that id with the same text meet in one task, which encodes the first. The join that finds the texts shuffles all of them. New counts are appended before they are
    read. Copies meet only as narrow rows, which adaptive execution may split. Repeated rows get the same counts. No
    rows: no rows, and nothing is appended. A carried column named like one of the result's own comes back as
    <name>_given.
    """
    spark, version = docs.sparkSession, tokenizer_version(model)
    whole = F.coalesce(F.col("text"), F.lit(""))
    content = F.sha2(whole, 256)
    # Copies are told apart by id, rows of one id that are copies of each other share a hash of everything else.
    ids = docs.select(content.alias("content"), F.xxhash64("doc_id").alias("pick"))
    missing = ids.join(_stored(spark, cache, version), "content", "left_anti").groupBy("content").agg(F.min("pick").alias("pick"))
    texts = docs.select(content.alias("content"), F.xxhash64("doc_id").alias("pick"), whole.alias("content_text"))
    chosen = texts.join(missing.hint("shuffle_hash"), ["content", "pick"], "left_semi").select("content", "content_text")
    counted = chosen.mapInArrow(_encode(model), "content string, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)

    rows = docs.select(F.struct(*carry).alias("_kept"), content.alias("content"), F.octet_length(whole).cast("long").alias("_bytes"))
    return rows.join(_stored(spark, cache, version), "content").select(
        *beside(carry, "n_bytes n_tokens over_limit"), F.col("_bytes").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
