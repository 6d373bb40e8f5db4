"""Language identification with a string kernel: blended spectrum, Nystroem landmarks, ridge regression.

The kernel of two texts is the number of byte n-grams (of the lower-cased UTF-8 text, orders 1 to 3) present in
both, over the root of the product of their numbers of n-grams.  A bounded, hash-ordered sample of labelled texts
of every language is fitted: some of them, the landmarks, span the Nystroem features K(x, L) K(L, L)^(-1/2), on
which one ridge regression per language is solved against one-versus-rest targets.  Scoring a batch is two matrix
products: presence rows times the landmarks' presence, then times the weights.  Landmarks are kept as
lists of places and made dense in blocks of at most BLOCK_BYTES.

A response over the root of the text's number of n-grams is their mean weight for the language, which hardly depends on the
text's length.  ``familiar`` is that of the winner relative to the median of the language's sample: near 1 in
ordinary text, near 0 in text of unlearned n-grams.

Definitions: a null text and one without a letter are ``und`` with score 0; if nothing was learned every text is
``und``; the score is the winner's share of the positive responses, between 0 and 1; ties go to the first language
by code point; repeated rows get equal results and are learned from once; whole texts are scored, whatever their length;
a row with a null doc_id has no remainder: it is neither learned from nor held out; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubflow.llm.common import slices

#: Bounds of the fitted sample: texts and landmarks of a language, and of all languages together (each language
#: has one at least).  Texts of more than TRAIN_CHARS characters are not sampled; a language that has no
#: other is learned from its shortest.
TRAIN_PER_LANG, LANDMARKS_PER_LANG, TRAIN_ALL, LANDMARKS_ALL, TRAIN_CHARS = 300, 40, 6000, 1600, 8000
SPARE = 3
ORDERS, RIDGE = (1, 2, 3), 1e-3
#: Bytes of a dense block of landmarks and of the presence rows of a batch; bytes of a text taken at a time.
BLOCK_BYTES, ROW_BYTES, TEXT_BYTES = 32 << 20, 8 << 20, 1 << 20


def grams(text: str) -> np.ndarray:
    """Distinct n-grams of a text as sorted codes: the bytes in base 256, after the codes of all shorter n-grams."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    out, shift = [], 0
    for n in ORDERS:
        some = [_distinct(raw[at:at + TEXT_BYTES + n - 1].astype(np.int32), n) for at in range(0, max(0, len(raw) - n + 1), TEXT_BYTES)]
        if some:
            out.append((some[0] if len(some) == 1 else np.unique(np.concatenate(some))) + shift)
        shift += 256 ** n
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def _distinct(raw: np.ndarray, n: int) -> np.ndarray:
    code = raw[:len(raw) - n + 1].copy()
    for k in range(1, n):
        code = (code << 8) + raw[k:len(raw) - n + 1 + k]
    code.sort()
    return code[np.concatenate([[True], code[1:] != code[:-1]])]


@dataclass
class Model:
    """vocabulary: sorted codes of the landmarks' n-grams; landmarks: their places in it; weights: K(., L) -> languages;
    usual: median of the winner's mean weight in each language's sample."""

    langs: list[str]
    vocabulary: np.ndarray
    landmarks: list[np.ndarray]
    weights: np.ndarray
    usual: np.ndarray
    dense: list = field(default_factory=list, repr=False)

    def presence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows, sizes = np.zeros((len(texts), len(self.vocabulary)), np.float32), np.ones(len(texts))
        for k, text in enumerate(texts):
            g = grams(text)
            at = np.minimum(np.searchsorted(self.vocabulary, g), len(self.vocabulary) - 1)
            rows[k, at[self.vocabulary[at] == g]] = 1
            sizes[k] = max(1, len(g))
        return rows, np.sqrt(sizes)

    def blocks(self):
        """(first landmark, dense presence over root size) in blocks; a single block is kept."""
        width = max(1, BLOCK_BYTES // (4 * max(1, len(self.vocabulary))))
        if self.dense:
            yield 0, self.dense[0]
            return
        for first in range(0, len(self.landmarks), width):
            some = self.landmarks[first:first + width]
            block = np.zeros((len(self.vocabulary), len(some)), np.float32)
            for c, places in enumerate(some):
                block[places, c] = 1 / np.sqrt(max(1, len(places)))
            if width >= len(self.landmarks):
                self.dense.append(block)
            yield first, block

    def kernel(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(kernel with every landmark, root of the number of n-grams) of each text."""
        at_once = max(1, min(128, ROW_BYTES // (4 * max(1, len(self.vocabulary)))))
        out, roots = np.zeros((len(texts), len(self.landmarks))), np.ones(len(texts))
        for k in range(0, len(texts), at_once):
            rows, root = self.presence(texts[k:k + at_once])
            roots[k:k + at_once] = root
            for first, block in self.blocks():
                out[k:k + at_once, first:first + block.shape[1]] = rows @ block
            out[k:k + at_once] /= root[:, None]
        return out, roots

    def responses(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(responses of every language, winner's mean weight relative to the usual) of each text."""
        kernel, root = self.kernel(texts)
        r = kernel @ self.weights
        best = r.argmax(axis=1) if len(texts) else np.zeros(0, np.int64)
        return r, (r[np.arange(len(r)), best] / root) / self.usual[best]

    def __getstate__(self):
        return {**self.__dict__, "dense": []}


def fit(texts: list[str], langs: list[str], landmarks_per_lang: int | None = None, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression on Nystroem features; the first texts of each language are its landmarks."""
    names = sorted(set(langs))
    per_lang = landmarks_per_lang or max(1, min(LANDMARKS_PER_LANG, LANDMARKS_ALL // max(1, len(names))))
    place, taken, marks = {x: i for i, x in enumerate(names)}, dict.fromkeys(names, 0), []
    for i, x in enumerate(langs):
        if taken[x] < per_lang:
            marks.append(i)
            taken[x] += 1
    marks.sort(key=lambda i: (place[langs[i]], i))
    found = [grams(texts[i]) for i in marks]
    vocabulary = np.unique(np.concatenate(found))
    model = Model(names, vocabulary, [np.searchsorted(vocabulary, g) for g in found], np.zeros((len(marks), len(names))), np.ones(len(names)))
    kernel, root = model.kernel(texts)
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-6 * max(values.max(), 1e-12)
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ whiten
    own = np.array([place[x] for x in langs])
    wanted = np.eye(len(names))[own]
    gram = features.T @ features + ridge * len(texts) * np.eye(features.shape[1])
    model.weights = whiten @ np.linalg.solve(gram, features.T @ wanted)
    mean_weight = (kernel @ model.weights)[np.arange(len(texts)), own] / root
    model.usual = np.array([max(1e-12, float(np.median(mean_weight[own == i]))) for i in range(len(names))])
    return model


def training_sample(docs: DataFrame, per_lang: int | None = None) -> tuple[list[str], list[str]]:
    """A bounded number of labelled texts with letters of each language, smallest hash first.

    Hashes are uniform, so the wanted rows lie below a threshold that follows from a language's count of distinct
    hashes, here with SPARE times the room: few rows are grouped, however many a language or a copy has.
    """
    spark = docs.sparkSession
    rows = docs.filter(F.col("lang").isNotNull() & has_letter(F.col("text"))).select(
        "text", "lang", F.xxhash64("doc_id", "text").alias("h"), F.char_length("text").alias("chars"))
    short = F.col("chars") <= TRAIN_CHARS
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(F.when(short, F.col("h"))).alias("n")).collect()  # a row for each language
    wanted = per_lang or max(1, min(TRAIN_PER_LANG, TRAIN_ALL // max(1, len(counts))))
    tops = [(r["lang"], min((1 << 63) - 1, -(1 << 63) + SPARE * wanted * (1 << 64) // r["n"])) for r in counts if r["n"]]
    below = spark.createDataFrame(tops, "l string, top long")
    # one row for each language, as just counted: broadcast, so that texts do not move before the threshold
    near = (rows.filter(short).join(F.broadcast(below), (F.col("lang") == F.col("l")) & (F.col("h") <= F.col("top")))
            .groupBy("lang", "h").agg(F.first("text").alias("text")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    got = [(r["lang"], r["h"], r["text"]) for r in near.withColumn("r", rank).filter(F.col("r") <= wanted).collect()]
    others = [r["lang"] for r in counts if not r["n"]]
    if others:
        shortest = rows.join(F.broadcast(spark.createDataFrame([(x,) for x in others], "l string")), F.col("lang") == F.col("l")).groupBy("lang").agg(
            F.min_by(F.struct("text", "h"), F.struct("chars", "h")).alias("x"))
        got += [(r["lang"], r["x"]["h"], r["x"]["text"]) for r in shortest.collect()]
    got.sort()
    return [t for _, _, t in got], [x for x, _, _ in got]


def has_letter(text):
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _score(shared):
    def run(batches):
        model = shared.value
        for b in batches:
            letters = b.column(3).to_numpy(zero_copy_only=False)
            pred, score, top, familiar = ["und"] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows), np.zeros(b.num_rows)
            for first, texts in slices(b.column(2)):
                some = [i for i in range(len(texts)) if letters[first + i]]
                if model is None or not some:
                    continue
                r, known = model.responses([texts[i] for i in some])
                best = r.argmax(axis=1)
                at = np.array(some) + first
                positive = np.maximum(r, 0).sum(axis=1)
                top[at], familiar[at] = r.max(axis=1), known
                score[at] = np.where(top[at] > 0, top[at] / np.maximum(positive, 1e-12), 0.0)
                for i, k in zip(at.tolist(), best.tolist()):
                    pred[i] = model.langs[k]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(pred), pa.array(np.clip(score, 0, 1)), pa.array(top), pa.array(familiar)],
                                  names=["doc_id", "text_key", "lang_pred", "score", "response", "familiar"])
    return run


def train(docs: DataFrame) -> Model | None:
    """Fits on a bounded sample of rows with a lang; None if there is none."""
    texts, langs = training_sample(docs)
    return fit(texts, langs) if texts else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, text_key, lang_pred, score, response (the winner's raw regression value), familiar for every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("string").alias("text")).withColumn("letters", has_letter(F.col("text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(shared), "doc_id long, text_key long, lang_pred string, score double, response double, familiar double")


def remainder(doc_id):
    """crc32 of the doc_id as text, modulo 4."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4
