"""Token counts as delta-maintained rollups.

Changes to documents come in batches: inserts, deletes and revised counts. Each
change is a signed row, a batch is summed by source, language and tokenizer
version, and the sums are stored as that batch's delta; totals are the sums of
the deltas. A batch becomes visible whole, through the renaming of its delta's
folder to the hash of its name, so committing it again, or after a crash half way,
changes nothing; batches may come in any order.

Sizes: deltas and totals have a row for each source, language and version;
partial aggregation precedes their shuffle, so a source with most of the rows
costs its task no more than another. :meth:`Rollup.compact` folds old deltas.

Edge cases: null texts count no tokens, null sources or languages are keys of
their own, repeated rows count again (batches, not rows, are idempotent), an
empty batch commits an empty delta, groups whose documents are all deleted are
left out of the totals, extra columns are not read; texts are counted whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kalendria.llm.support import hadoop_path, scratch_dir

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens", "n_chars"]


@functools.cache
def encoding(path: str):
    """The tokenizer of a rank file, one a worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, ranks: str = DEFAULT_RANKS, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(doc_id, source, lang, n_chars, n_bytes, n_tokens) for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks)
        for b in batches:
            n = np.fromiter((len(enc.encode_ordinary(x.as_py() or "")) for x in b.column(5)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(n)], ["doc_id", "source", "lang", "n_chars", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.length(text).cast("long").alias("n_chars"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("doc_id", "source", "lang")}
    return rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, source {kinds['source']}, lang {kinds['lang']}, n_chars bigint, n_bytes bigint, n_tokens bigint")


def _signed(counts: DataFrame, tokenizer: str, docs: int, tokens: Column, chars: Column) -> DataFrame:
    return counts.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(docs).cast("long").alias("n_docs"), tokens.cast("long").alias("n_tokens"), chars.cast("long").alias("n_chars"))


def inserted(counts: DataFrame, tokenizer: str, tokens: str = "n_tokens") -> DataFrame:
    return _signed(counts, tokenizer, 1, F.col(tokens), F.col("n_chars"))


def deleted(counts: DataFrame, tokenizer: str, tokens: str = "n_tokens") -> DataFrame:
    return _signed(counts, tokenizer, -1, -F.col(tokens), -F.col("n_chars"))


def revised(counts: DataFrame, tokenizer: str, old: str, new: str) -> DataFrame:
    """Counts that change from column ``old`` to column ``new``; documents and characters stay."""
    return _signed(counts, tokenizer, 0, F.col(new) - F.col(old), F.lit(0))


class Rollup:
    """Totals below ``path``, kept through committed batches of signed changes.

    ``deltas/<hash of the batch>`` is a batch's delta, ``bases/<number>`` the sums
    of batches that were folded and the list of them. Each comes into being whole,
    by the renaming of a folder, so that a crash leaves it either there or not.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, schema: str = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"):
        self.spark, self.path, self.schema = spark, path or scratch_dir(spark), schema

    def _publish(self, made: str, name: str) -> bool:
        """Renames a finished folder to its name; False if the name was taken."""
        fs, to = hadoop_path(self.spark, f"{self.path}/{name}")
        _, own = hadoop_path(self.spark, f"{self.path}/{made}")
        fs.mkdirs(to.getParent())
        taken = bool(fs.exists(to))
        if not taken:
            fs.rename(own, to)
            # a rename onto a folder that another writer made meanwhile puts ours inside it
            _, inside = hadoop_path(self.spark, f"{self.path}/{name}/{made}")
            taken = bool(fs.exists(inside))
            fs.delete(inside, True)
        fs.delete(own, True)
        return not taken

    def _names(self, folder: str, pattern: str) -> list[str]:
        fs, p = hadoop_path(self.spark, f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n for n in names if re.fullmatch(pattern, n))

    def _base(self) -> tuple[str | None, set[str]]:
        """The last base and the batches folded into it."""
        names = self._names("bases", r"\d{12}")
        if not names:
            return None, set()
        fs, p = hadoop_path(self.spark, f"{self.path}/bases/{names[-1]}/_batches")
        stream = fs.open(p)
        folded = set(bytes(stream.readAllBytes()).decode().split())
        stream.close()
        return names[-1], folded

    def committed(self, batch: str) -> bool:
        name = _hash(batch)
        fs, p = hadoop_path(self.spark, f"{self.path}/deltas/{name}")
        return bool(fs.exists(p)) or name in self._base()[1]

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch once; False if it was there already."""
        if self.committed(batch):
            return False
        made = f"_{uuid.uuid4().hex}"
        _summed(changes).write.parquet(f"{self.path}/{made}")
        return self._publish(made, f"deltas/{_hash(batch)}")

    def _rows(self) -> tuple[DataFrame, list[str], set[str]]:
        """All there is to sum, the deltas among it, and the batches folded before."""
        base, folded = self._base()
        fresh = [n for n in self._names("deltas", "[0-9a-f]{64}") if n not in folded]
        paths = [f"{self.path}/deltas/{n}" for n in fresh] + ([f"{self.path}/bases/{base}"] if base else [])
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema), fresh, folded

    def totals(self) -> DataFrame:
        """Sums by source, language and tokenizer version over all committed batches."""
        return _summed(self._rows()[0]).filter(F.col("n_docs") != 0)

    def compact(self) -> None:
        """One base in place of all there is; batches stay committed, and groups without documents keep their sums. One compaction at a time."""
        rows, fresh, folded = self._rows()
        if len(fresh) > 1:
            base, made = self._base()[0], f"_{uuid.uuid4().hex}"
            _summed(rows).write.parquet(f"{self.path}/{made}")
            fs, p = hadoop_path(self.spark, f"{self.path}/{made}/_batches")
            out = fs.create(p, False)
            out.write(bytearray("\n".join(sorted(folded | set(fresh))).encode()))
            out.close()
            if self._publish(made, f"bases/{int(base or 0) + 1:012d}"):
                # what a crash leaves of these is passed over: the base names them
                for n in fresh:
                    fs.delete(hadoop_path(self.spark, f"{self.path}/deltas/{n}")[1], True)


def _hash(batch: str) -> str:
    return hashlib.sha256(batch.encode()).hexdigest()


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))
