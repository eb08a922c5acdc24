"""Language identification by hierarchical discrimination.

A text's UTF-8 bytes, lower-cased and with everything but letters folded to one
space, give hashed byte trigrams and 4-grams. Linear support vector machines
(squared hinge, fitted here) first choose the language family, one against one;
then, inside the family, one-against-one machines tell its languages apart.

Fitting uses at most ``PER_LANGUAGE`` labelled rows of each language (fewer where
that would come to more than ``SAMPLE_ROWS`` in all), those with the least hashes
of id and text, repeated rows once. Their n-gram counts are taken where the rows
are, so the driver gets ``BUCKETS`` numbers a row at most, however long the texts,
and holds them without their zeros; the machines are fitted on the products of
rows. Prediction reads every row and the whole text. The model is a matrix of 64 KB for
each pair of families and of languages inside a family, which travels with the task.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; ids
may be null or repeat, each row has its own result and may be fitted on; null
labels are not learned;
without any labelled row all is ``und``; one learned language is predicted
always; ties go to the language that sorts first; extra columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.llm.support import lean

# Language families; a language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no is af".split(),
    "romance": "fr es it pt ro ca gl".split(),
    "slavic": "ru uk pl cs sk bg sr hr sl".split(),
}

UNKNOWN = "und"
#: Labelled rows used for fitting, at most, of a language and in all.
PER_LANGUAGE, SAMPLE_ROWS = 400, 6_400
BUCKETS = 1 << 14
LETTER = regex.compile(r"\p{L}")
#: Bytes: ASCII letters to lower case, other ASCII to space, the rest as they are.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c) in string.ascii_lowercase else 32 for c in range(256))
SPACES = regex.compile(rb" {2,}")
PIECE = 1 << 20
#: Buckets of all rows, and rows, whose products are taken at once.
COLUMNS, ROWS = 512, 512


def buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of the text's byte trigrams and 4-grams, a piece of the text at a time."""
    data = np.frombuffer(SPACES.sub(b" ", b" " + text.lower().encode().translate(FOLD) + b" "), np.uint8)
    for at in range(0, max(1, len(data) - 2), PIECE):
        b = data[at : at + PIECE + 3].astype(np.uint32)
        tri = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        last = at + PIECE >= len(data) - 2
        four = (tri[:-1] << 8) | b[3:]
        tri = tri if last else tri[:-1]
        yield (tri * np.uint32(2654435761)) >> np.uint32(18)
        yield (four * np.uint32(2246822519) + np.uint32(97)) >> np.uint32(18)


def profile(text: str) -> np.ndarray:
    """Relative frequency of each bucket."""
    total = np.zeros(BUCKETS, np.float32)
    for b in buckets(text):
        total += np.bincount(b, minlength=BUCKETS)
    return total / max(1.0, total.sum())


class Profiles:
    """Profiles of texts without their zeros: row i has ``share`` in the buckets ``at``, from ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, starts: np.ndarray, at: np.ndarray, share: np.ndarray):
        self.starts, self.at, self.share = starts, at, share

    def __len__(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of(cls, rows: Iterable[np.ndarray]) -> Profiles:
        found = [(at := np.flatnonzero(p).astype(np.int32), p[at]) for p in rows]
        starts = np.cumsum([0, *(len(at) for at, _ in found)])
        return cls(starts, np.concatenate([np.zeros(0, np.int32), *(x[0] for x in found)]), np.concatenate([np.zeros(0, np.float32), *(x[1] for x in found)]))

    def scales(self) -> np.ndarray:
        """For each bucket one over the root of its mean share."""
        mean = np.bincount(self.at, self.share, BUCKETS) / max(1, len(self))
        return (1 / np.sqrt(mean + 1e-6)).astype(np.float32) if len(self) else np.ones(BUCKETS, np.float32)

    def times(self, v: np.ndarray) -> np.ndarray:
        """The product of each row with a vector over the buckets."""
        out = np.zeros(len(self), np.float32)
        for i, (a, b) in enumerate(pairwise(self.starts)):
            out[i] = self.share[a:b] @ v[self.at[a:b]]
        return out

    def summed(self, rows: slice, weights: np.ndarray) -> np.ndarray:
        """The weighted sum of some rows."""
        total = np.zeros(BUCKETS, np.float64)
        for i, w in zip(range(rows.start, rows.stop), weights, strict=True):
            a, b = self.starts[i : i + 2]
            total[self.at[a:b]] += w * self.share[a:b]
        return total

    def products(self, scale: np.ndarray) -> np.ndarray:
        """The products of all pairs of rows, scaled; some buckets of all rows are spread out at once."""
        n = len(self)
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.starts))
        out = np.zeros((n, n), np.float32)
        for lo in range(0, BUCKETS, COLUMNS):
            held = np.flatnonzero((self.at >= lo) & (self.at < lo + COLUMNS))
            some = np.zeros((n, COLUMNS), np.float32)
            some[row[held], self.at[held] - lo] = self.share[held] * scale[self.at[held]]
            for i in range(0, n, ROWS):
                out[i : i + ROWS, : i + ROWS] += some[i : i + ROWS] @ some[: i + ROWS].T
        for i in range(0, n, ROWS):
            out[:i, i : i + ROWS] = out[i : i + ROWS, :i].T
        return out


def linear_svm(k: np.ndarray, parts: list[slice], y: np.ndarray, first: np.ndarray, rounds: int = 200, c: float = 10.0) -> tuple[np.ndarray, float]:
    """What each row of ``parts`` adds to the weights, and the bias, under L2-regularised squared hinge loss, y in {-1, 1}.

    Accelerated gradient steps. Weights are sums of rows all the way, so that the
    products ``k`` of the rows are all that is needed. ``first`` starts the search
    for their largest eigenvalue.
    """
    n = len(y)
    ends = np.cumsum([0, *(p.stop - p.start for p in parts)])

    def times(u: np.ndarray) -> np.ndarray:
        return np.concatenate([sum(k[p, q] @ u[a:b] for q, (a, b) in zip(parts, pairwise(ends), strict=True)) for p in parts])

    weight = np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum()))).astype(np.float32)
    w, b = np.zeros(n, np.float32), 0.0
    v, vb = w.copy(), b
    u = first
    for _ in range(20):
        ku = times(u)
        u = ku / (np.sqrt(max(0.0, float(u @ ku))) or 1)
    lipschitz = 1 + 2 * c / n * float(weight.max()) * (float(u @ u) + n)
    for t in range(1, rounds + 1):
        slack = np.maximum(0, 1 - y * (times(v) + vb)) * weight
        gw, gb = v - (2 * c / n) * (y * slack), -(2 * c / n) * float((y * slack).sum())
        nw, nb = v - gw / lipschitz, vb - gb / lipschitz
        m = (t - 1) / (t + 2)
        v, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, b


class LanguageModel:
    """Family machines, then machines for each pair of languages inside a family."""

    def __init__(self, langs: list[str], families: dict[str, list[str]] | None = None):
        of = {lang: f for f, ls in (families or FAMILIES).items() for lang in ls}
        self.langs = sorted(langs)
        self.family = {lang: of.get(lang, f"only {lang}") for lang in self.langs}
        self.groups: dict[str, list[str]] = {}
        for lang in self.langs:
            self.groups.setdefault(self.family[lang], []).append(lang)
        self.duels = [("family", a, b) for a, b in combinations(sorted(self.groups), 2)] + [(f, a, b) for f in sorted(self.groups) for a, b in combinations(self.groups[f], 2)]
        self.weights = np.zeros((BUCKETS, len(self.duels)), np.float32)
        self.bias = np.zeros(len(self.duels), np.float32)

    def fit(self, texts: list[str], labels: list[str]) -> LanguageModel:
        rows = sorted(zip(labels, texts, strict=True), key=lambda r: r[0])
        return self.fit_profiles(Profiles.of(profile(t) for _, t in rows), [lab for lab, _ in rows])

    def fit_profiles(self, x: Profiles, labels: list[str]) -> LanguageModel:
        """As :meth:`fit`, from the texts' profiles, those of a language side by side."""
        scale = x.scales()
        k = x.products(scale)
        first = x.times(scale * np.random.default_rng(0).standard_normal(BUCKETS).astype(np.float32))
        names = np.array(labels, dtype=object)
        parts = {lang: slice(int(at[0]), int(at[-1]) + 1) for lang in self.langs if len(at := np.flatnonzero(names == lang))}
        for i, (level, a, b) in enumerate(self.duels):
            sides = {lang: 1.0 if (self.family[lang] if level == "family" else lang) == a else -1.0 for lang in parts if (self.family[lang] if level == "family" else lang) in (a, b)}
            if not sides:
                continue
            own = [parts[lang] for lang in sides]
            y = np.concatenate([np.full(p.stop - p.start, side, np.float32) for p, side in zip(own, sides.values(), strict=True)])
            w, bias = linear_svm(k, own, y, np.concatenate([first[p] for p in own]))
            ends = np.cumsum([0, *(p.stop - p.start for p in own)])
            total = sum(x.summed(p, w[s:e]) for p, (s, e) in zip(own, pairwise(ends), strict=True))
            self.weights[:, i], self.bias[i] = total * scale.astype(np.float64) ** 2, bias
        return self

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.duels), np.float64), 0
        for b in buckets(text):
            total += self.weights[b].sum(axis=0, dtype=np.float64)
            n += len(b)
        margins = total / max(1, n) + self.bias
        family, p = self._winner("family", sorted(self.groups), margins)
        lang, q = self._winner(family, self.groups[family], margins)
        return lang, p * q

    def _winner(self, level: str, names: list[str], margins: np.ndarray) -> tuple[str, float]:
        """Most duels won, then the sum of margins; the probability of its closest duel."""
        won, least = dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
        for (at, a, b), m in zip(self.duels, margins, strict=True):
            if at == level:
                p = 1 / (1 + np.exp(-2 * np.clip(m, -30, 30)))
                won[a] += (m >= 0) + np.tanh(m) / 1e3
                won[b] += (m < 0) - np.tanh(m) / 1e3
                least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
        best = min(names, key=lambda n: (-won[n], n))
        return best, float(least[best])


def held_out(id_col: Column) -> Column:
    """Rows that no fitting may see: those with crc32(id as text) mod 4 = 2."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2, F.lit(False))


def _least_draws(most: int):
    """The ``most`` least draws of each language in a task, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for b in batches:
            names, draws = b.column(0).dictionary_encode(), b.column(1).to_numpy()
            for i, lang in enumerate(names.dictionary.to_pylist()):
                found = draws[names.indices.to_numpy(zero_copy_only=False) == i]
                held[lang] = np.unique(np.concatenate([held.get(lang, found[:0]), found]))[:most]
        for lang, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64())], ["lang", "draw"])

    return run


def fit_languages(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang", per_language: int = PER_LANGUAGE, families: dict | None = None) -> LanguageModel:
    """A model of the labelled rows outside the held-out quarter; at most ``per_language`` rows of each language."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    draw = F.xxhash64("doc_id", "text")
    keyed = rows.select("lang", draw.alias("draw")).mapInArrow(_least_draws(per_language), "lang string, draw bigint").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    least = keyed.withColumn("n", place).filter(F.col("n") <= per_language).groupBy("lang").agg(F.collect_list("draw").alias("draws")).collect()
    langs = sorted(r["lang"] for r in least)
    if not langs:
        return LanguageModel([])
    each = max(1, min(per_language, SAMPLE_ROWS // len(langs)))
    bound = {r["lang"]: sorted(r["draws"])[:each][-1] for r in least}
    admit = F.element_at(F.create_map(*(F.lit(v) for pair in bound.items() for v in pair)), F.col("lang"))
    drawn = rows.withColumn("draw", draw).filter(F.col("draw") <= admit).dropDuplicates(["lang", "draw"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, order, text in zip(b.column(0), b.column(1), b.column(2), strict=True):
                p = profile(text.as_py())
                at = np.flatnonzero(p)
                arrays = [pa.array([lang.as_py()], pa.string()), pa.array([order.as_py()], pa.int64()), pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([p[at]], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "draw", "at", "share"])

    found = drawn.select("lang", "draw", "text").mapInArrow(count, "lang string, draw bigint, at array<int>, share array<float>").toArrow().sort_by([("lang", "ascending"), ("draw", "ascending")])
    rows = found.combine_chunks()
    at, share = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in (rows.column("at"), rows.column("share")))
    x = Profiles(at.offsets.to_numpy().astype(np.int64), at.values.to_numpy(), share.values.to_numpy())
    return LanguageModel(langs, families).fit_profiles(x, rows.column("lang").to_pylist())


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang", least_score: float = 0.0) -> DataFrame:
    """``docs`` with the predicted language in ``lang_col``; rows that are ``und`` or score under ``least_score`` go."""
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(x.as_py()) for x in b.column(at)]
            named = b.set_column(lang_at, b.schema.field(lang_at), pa.array([g[0] for g in got], b.schema.field(lang_at).type))
            yield named.filter(pa.array([g[0] != UNKNOWN and g[1] >= least_score for g in got], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
