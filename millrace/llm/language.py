"""Language identification in two steps: family first, then languages within the family.

Both steps are linear support vector machines, one for each pair of classes, on counts of three-byte sequences of
the lower-cased text's letters divided by their number.  A pair's margin becomes a probability by the logistic function; a class's
share is the mean over its pairs, and the score of a language is its family's share times its own.  More than ``WIDTH``
families are first bundled by likeness, over as many steps as it takes; the score is then the product over all steps.

Training learns every label, from about ``PER_LANGUAGE`` labelled documents of each, chosen by a hash of the document id;
with many labels from fewer of each, so that all are about ``ROWS``, but never from fewer than about ``LEAST_ROWS``.
A pair's weights take a quarter of a megabyte, and there are about four pairs to a label beyond ``WIDTH`` families.
Every prediction reads the whole text.

Every class has a share too, so scores tell languages apart but never reject a text.  That is what ``known`` is for: the
share of the text's sequences of at least two letters that are usual in a language (``USUAL`` of its training
documents' sequences or more, in two different texts at least), divided by the median of this share over its training documents, each held against the
others; the largest of all languages counts, so a text taken for the wrong language stays.  A text without such a sequence has nothing to be rejected by and gets 1, as does a text in
a language learned from one or two documents.  Junk that makes up a part of a label's documents is usual there.  Null texts and texts without a letter get ``und``
and score 0; so does everything if no labelled document exists.  With one label in all, every text with a letter gets
it with score 1.  Ties go to the alphabetically first class.  Repeated rows get equal results; other columns aren't
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, utf8

UNKNOWN = "und"
BUCKETS = 1 << 16
PER_LANGUAGE = 1500
ROWS = 64 * PER_LANGUAGE
LEAST_ROWS = 20
WIDTH = 16
USUAL = 5e-5

#: Families of language codes.  A code that isn't here is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nb", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("bn", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "tr", "uz"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_ASCII_LETTER = re.compile("[A-Za-z]")
_SLICE = 1 << 20
#: Bytes that take part: ASCII letters and all bytes of longer characters; digits, marks and controls become spaces.
_LETTERS = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def family(language: str) -> str:
    return _FAMILY.get(language, language)


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def grams(text: str) -> Iterator[np.ndarray]:
    """Bucket of every three-byte sequence of the text between spaces, about a megabyte at a time."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
    for at in range(0, len(data) - 2, _SLICE):
        b = _LETTERS[data[at:at + _SLICE + 2]]
        code = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        yield _bucket(code)


def _bucket(code: np.ndarray) -> np.ndarray:
    return (code * np.uint32(2654435761)) >> np.uint32(16)


def _bare() -> np.ndarray:
    """Buckets of sequences with less than two letters, which any text has."""
    letter, space = np.unique(_LETTERS), np.uint32(32)
    return np.unique(_bucket(np.concatenate([letter | (space << np.uint32(8)) | (space << np.uint32(16)), space | (letter << np.uint32(8)) | (space << np.uint32(16)), space | (space << np.uint32(8)) | (letter << np.uint32(16))])))


#: Whether a bucket's sequences tell of a language.
_TELLING = ~np.isin(np.arange(BUCKETS), _bare())


_SAMPLE = pa.schema([("lang", pa.string()), ("at", pa.binary()), ("value", pa.binary())])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, ats, values = [], [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not has_letter(text):
                continue
            count = np.zeros(BUCKETS, np.int64)
            for g in grams(text):
                count += np.bincount(g, minlength=BUCKETS)
            at = np.flatnonzero(count)
            langs.append(lang)
            ats.append(at.astype(np.uint16).tobytes())
            values.append((count[at] / count.sum()).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((langs, ats, values), _SAMPLE, strict=True)], schema=_SAMPLE)


def fit_pair(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, cost: float = 10.0, rounds: int = 12) -> np.ndarray:
    """Weights and, last, the offset of a linear machine with squared hinge loss, by dual coordinate descent."""
    w, alpha, order = np.zeros(BUCKETS + 1), np.zeros(len(rows)), np.random.default_rng(7)
    norm = np.array([float(v @ v) + 1.0 for _, v in rows]) + 0.5 / cost
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            slope = sign[i] * (w[at] @ value + w[-1]) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - slope / norm[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[at] += step * value
                w[-1] += step
                alpha[i] = new
    return w


class Pairs:
    """One machine for each pair of classes."""

    def __init__(self, names: list[str]):
        self.names, self.pairs = sorted(names), list(combinations(range(len(names)), 2))
        self.weights = np.zeros((BUCKETS + 1, len(self.pairs)), np.float32)

    def fit(self, rows: list, labels: list[str]) -> Pairs:
        named = np.array([self.names.index(x) for x in labels])
        for k, (i, j) in enumerate(self.pairs):
            own = np.flatnonzero((named == i) | (named == j))
            self.weights[:, k] = fit_pair([rows[r] for r in own], np.where(named[own] == i, 1.0, -1.0))
        return self

    def best(self, margins: np.ndarray) -> tuple[str, float]:
        if not self.pairs:
            return self.names[0], 1.0
        chance, share = 1 / (1 + np.exp(-np.clip(2 * margins, -40, 40))), np.zeros(len(self.names))
        for (i, j), p in zip(self.pairs, chance, strict=True):
            share[i] += p
            share[j] += 1 - p
        first = int(share.argmax())
        return self.names[first], float(share[first] / (len(self.names) - 1))


#: Three-byte sequences of one text share their weight, so vectors are scaled to about unit length for training.
_SCALE = 20.0


def usual(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Which buckets are usual in a language, as bits, and the median share of usual ones in its documents."""
    once = {(at.tobytes(), value.tobytes()): (at, value) for at, value in rows}.values()
    told = [(at[own], value[own] / value[own].sum()) for at, value in once if (own := _TELLING[at]).any()]
    total, texts = np.zeros(BUCKETS), np.zeros(BUCKETS, np.int64)
    for at, value in told:
        total[at] += value
        texts[at] += 1
    shares = [value[(total[at] - value >= USUAL * (len(told) - 1)) & (texts[at] > 2)].sum() for at, value in told] or [0.0]
    return np.packbits((total >= USUAL * len(told)) & (texts > 1)), float(np.median(shares))


def bundles(names: list[str], centres: np.ndarray, number: int) -> list[list[str]]:
    """Names in bundles of like centres: each joins the nearest of far apart seeds that has room."""
    seeds, far = [0], np.full(len(names), np.inf)
    while len(seeds) < number:
        far = np.minimum(far, ((centres - centres[seeds[-1]]) ** 2).sum(axis=1))
        far[seeds] = -1
        seeds.append(int(far.argmax()))
    out = [[names[i]] for i in seeds]
    for i in range(len(names)):
        if i not in seeds:
            near = np.argsort(((centres[seeds] - centres[i]) ** 2).sum(axis=1), kind="stable")
            next(out[k] for k in near if len(out[k]) * number < 2 * len(names)).append(names[i])
    return out


class Model:
    """Families, and the languages of each, as a tree of (machines, class name to language or next node)."""

    def __init__(self, rows: list, labels: list[str]):
        self.languages, families = sorted(set(labels)), {}
        for x in self.languages:
            families.setdefault(family(x), []).append(x)
        if labels:
            self.root = self._grow(families, rows, labels)
        by = {x: [] for x in self.languages}
        for r, x in zip(rows, labels, strict=True):
            by[x].append(r)
        told = [usual(own) for own in by.values()]
        self.usual, self.typical = np.array([bits for bits, _ in told]), np.array([typical for _, typical in told])

    def _grow(self, groups: dict[str, list[str]], rows: list, labels: list[str]):
        """``groups`` are classes of this node and their languages; only rows of these languages take part."""
        names, inner = sorted(groups), {name: {x: [x] for x in own} for name, own in groups.items()}
        if len(names) > WIDTH:
            of = {x: i for i, name in enumerate(names) for x in groups[name]}
            centres, size = np.zeros((len(names), 1024)), np.zeros((len(names), 1))
            for (at, value), x in zip(rows, labels, strict=True):
                centres[of[x]] += np.bincount(at % 1024, value, 1024)
                size[of[x]] += 1
            parts = bundles(names, centres / size, WIDTH // 2)
            inner = {min(own): {name: groups[name] for name in own} for own in parts}
        named = {x: name for name, own in inner.items() for xs in own.values() for x in xs}
        node = Pairs(list(inner)).fit(rows, [named[x] for x in labels])
        below = {}
        for name, own in inner.items():
            at = [i for i, x in enumerate(labels) if named[x] == name]
            one = [x for xs in own.values() for x in xs]
            below[name] = one[0] if len(one) == 1 else self._grow(own, [rows[i] for i in at], [labels[i] for i in at])
        return node, below

    def known(self, language: str, at: np.ndarray, number: np.ndarray) -> float:
        telling = _TELLING[at]
        at, number = at[telling], number[telling]
        if not len(at) or not self.typical[self.languages.index(language)]:
            return 1.0
        own = (self.usual[:, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        share = own @ number / number.sum() / np.where(self.typical > 0, self.typical, np.inf)
        return float(min(1.0, share.max()))

    def predict(self, text: str | None, known: bool = True) -> tuple[str, float, float]:
        """Language, score and, if asked, known share."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        found = np.zeros(BUCKETS, np.int64)
        for g in grams(text):
            found += np.bincount(g, minlength=BUCKETS)
        at = np.flatnonzero(found)
        number, score, node = found[at] * (_SCALE / found.sum()), 1.0, self.root
        while not isinstance(node, str):
            pairs, below = node
            name, share = pairs.best(number @ pairs.weights[at] + pairs.weights[-1])
            score, node = score * share, below[name]
        return node, score, self.known(node, at, number) if known else 1.0


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept for measuring: one fifth by the crc32 of the id's text; a null id counts as trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled documents that aren't held out.

    Two scans: labels are counted first (a small aggregate), then documents whose hash lies below their label's rate
    become sparse vectors in the tasks.  The driver gets at most about ``ROWS`` of them, or LEAST_ROWS of each label.
    """
    bound_batches(docs.sparkSession)
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out())
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return Model([], [])
    each = max(LEAST_ROWS, min(PER_LANGUAGE, ROWS // len(counts)))
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, each / r["count"])) for r in counts], "lang string, rate double")
    share = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) / 1_000_000.0
    sample = labelled.withColumn("share", share).join(rates, "lang").where("share < rate")
    sample = sample.select("lang", "text").mapInArrow(_vectors, "lang string, at binary, value binary")
    rows = sorted((r["lang"], bytes(r["at"]), bytes(r["value"])) for r in sample.collect())
    vectors = [(np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(v, np.float32) * np.float32(_SCALE)) for _, a, v in rows]
    return Model(vectors, [r[0] for r in rows])


def _predictor(model: Model, known: bool = False):
    names = ["lang_pred", "score", *["known"] * known]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every column but the last, the text, passes through."""
        for batch in batches:
            found = [model.predict(t, known) for t in batch.column(batch.num_columns - 1).to_pylist()]
            new = [pa.array([x[k] for x in found], pa.float64() if k else pa.string()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + new, names=[*batch.schema.names[:-1], *names])

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, in one scan without an exchange."""
    bound_batches(docs.sparkSession)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(_predictor(model), "doc_id long, held_out boolean, lang_pred string, score double")


def label_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc``, the document's row as it was, with lang_pred, score and known."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    ddl = f"doc {rows.schema['doc'].dataType.simpleString()}, lang_pred string, score double, known double"
    return rows.mapInArrow(_predictor(model, known=True), ddl)
