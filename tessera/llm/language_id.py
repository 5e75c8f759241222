"""Language identification with interpolated Kneser-Ney character language models.

Text is lower-cased code point by code point; everything but letters becomes a space.  For each
language, n-grams up to ORDER are counted on a bounded sample of labelled documents (in the order
of a hash, as long as they fit into CHARS characters a language; of a document longer than a
SHARE-th of that its beginning) and turned into
interpolated Kneser-Ney probabilities (one discount an order, continuation counts below the top
order, uniform over code points at the end).  The n-grams of all languages share one sorted array of 64-bit
hashes per order with a row of log probabilities, a column a language, plus back-off weights by context.

A text goes to the language with the lowest cross-entropy per scored character over its whole
length.  Rejection is calibrated: a fifth of the sample isn't counted but scored, and a text
whose cross-entropy lies above the 99.9 % point of its language there (plus a margin for short
texts) is rejected.  The confidence is a softmax of the cross-entropies whose temperature is
fitted on the same fifth.

Null texts and texts without a letter get ``und`` and score 0.  Ties go to the language that
sorts first.  Without labelled documents every text gets ``und``.  Repeated rows are judged each; rows
without doc_id too, but they are neither learned from nor held out.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

ORDER = 4
#: Characters of labelled text a language that models are fitted on, at most.
CHARS = 1_500_000
#: Characters of labelled text in all: with more languages than fit, each has an equal share.
TOTAL_CHARS = 200_000_000
#: The table of languages, a row of three short values each, is broadcast up to this count of rows; beyond it the join shuffles.
BROADCAST_LANGUAGES = 100_000
#: A document gives 1 / SHARE of CHARS at most, so a language has SHARE documents in the sample if it has as many.
SHARE = 10
UNDETERMINED = "und"
_MUL = np.random.default_rng(11).integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_UNIFORM = float(np.log(1 / 0x11000))


@functools.lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    """Code point -> lower-cased letter, combining mark (vowel signs and accents are part of words) or space."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x32400):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
        elif unicodedata.category(ch)[0] == "M":
            table[c] = c
    return table


def _stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of all texts with ORDER spaces before each; places to score; text of each place."""
    pad = "\n" * ORDER
    raw = np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    c = _lower()[raw]
    letter = c != 32
    score = letter.copy()
    score[1:] |= letter[:-1]  # letters and the space after a word
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + ORDER) + ORDER  # first place after a text's own pad
    places = np.flatnonzero(score)
    return c, places, np.searchsorted(ends, places, side="right")


def _keys(c: np.ndarray) -> list[np.ndarray]:
    """keys[n][i]: hash of the n code points that end at place i (wrong for i < n, which is padding)."""
    out = [np.zeros(len(c), np.uint64)]
    wide = c.astype(np.uint64) + np.uint64(1)
    for n in range(1, ORDER + 1):
        part = wide * _MUL[n - 1]
        if n > 1:
            part = np.concatenate([np.zeros(n - 1, np.uint64), part[: -(n - 1)]])
            part += out[n - 1]
        out.append(part)
    return [o ^ (o >> np.uint64(29)) for o in out]


class _Sorted:
    """Sorted 64-bit hashes with an index on their top bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.concatenate([keys, np.full(64, 2**64 - 1, np.uint64)])
        bits = max(1, min(22, int(np.ceil(np.log2(max(2, len(keys))))) + 1))
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(2**bits, dtype=np.uint64) << self.shift).astype(np.int32)
        sizes = np.diff(np.concatenate([self.first, [len(keys)]]))
        self.most = int(sizes.max(initial=0))

    def find(self, asked: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 if absent."""
        at = self.first[(asked >> self.shift).astype(np.int64)]
        row = np.where(self.keys[at] == asked, at, -1)
        open_ = np.flatnonzero(row < 0)
        for step in range(1, self.most):
            if not len(open_):
                break
            here = at[open_] + step
            own = self.keys[here]
            hit = own == asked[open_]
            row[open_[hit]] = here[hit]
            open_ = open_[~hit & (own < asked[open_])]
        return row


class Model:
    """Languages, sorted hashes, log probabilities and back-off weights of each order."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        k = len(self.languages)
        seen: list[dict] = []  # by language: order -> (keys, context keys, suffix keys, count)
        for lang in self.languages:
            c, places, _ = _stream(samples[lang] or [""])
            keys = _keys(c)
            own = {}
            for n in range(ORDER, 0, -1):
                if n == ORDER:
                    u, first, count = np.unique(keys[n][places], return_index=True, return_counts=True)
                    at = places[first]
                else:  # continuation counts: distinct n+1-grams that end in it
                    up = own[n + 1]
                    u, first, count = np.unique(keys[n][up["at"]], return_index=True, return_counts=True)
                    at = up["at"][first]
                own[n] = {"key": u, "at": at, "count": count.astype(np.float64), "context": keys[n - 1][at - 1], "suffix": keys[n - 1][at]}
            seen.append(own)
        self.tables: list[_Sorted | None] = [None]
        self.logp: list[np.ndarray] = [np.full((1, k), _UNIFORM, np.float32)]
        self.gamma: list[np.ndarray] = []  # gamma[n]: rows of the order-n contexts of (n+1)-grams
        every = [None] + [np.unique(np.concatenate([s[n]["key"] for s in seen])) if k else np.zeros(0, np.uint64) for n in range(1, ORDER + 1)]
        probability: np.ndarray = np.full((1, k), np.exp(_UNIFORM))
        for n in range(1, ORDER + 1):
            table = _Sorted(every[n])
            size = len(every[n])
            context, suffix = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
            for s in seen:
                rows = table.find(s[n]["key"])
                context[rows], suffix[rows] = s[n]["context"], s[n]["suffix"]
            lower_rows = np.zeros(size, np.int64) if n == 1 else self.tables[n - 1].find(suffix)
            context_rows = np.zeros(size, np.int64) if n == 1 else self.tables[n - 1].find(context)
            n_contexts = 1 if n == 1 else len(every[n - 1])
            gamma = np.ones((n_contexts, k))
            p = np.zeros((size, k))
            for j, s in enumerate(seen):
                own = s[n]
                rows = table.find(own["key"])
                once, twice = (own["count"] == 1).sum(), (own["count"] == 2).sum()
                d = once / (once + 2 * twice) if once + 2 * twice else 0.5
                d = min(max(d, 0.1), 0.95)
                ctx = context_rows[rows]
                ok = ctx >= 0
                total = np.bincount(ctx[ok], own["count"][ok], n_contexts)
                types = np.bincount(ctx[ok], minlength=n_contexts)
                some = total > 0
                gamma[some, j] = d * types[some] / total[some]
                p[rows[ok], j] = np.maximum(own["count"][ok] - d, 0) / total[ctx[ok]]
            back = gamma[np.maximum(context_rows, 0)]
            back[context_rows < 0] = 1
            probability = p + back * np.where(lower_rows[:, None] >= 0, probability[np.maximum(lower_rows, 0)], np.exp(_UNIFORM))
            self.tables.append(table)
            self.logp.append(np.log(probability).astype(np.float32))
            self.gamma.append(np.log(gamma).astype(np.float32))
        self.limit = np.full(k, np.inf)
        self.spread = np.zeros(k)
        self.temperature = 10.0

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages) nats per scored character, over whole texts; scored characters of each."""
        texts = [t or "" for t in texts]
        k = len(self.languages)
        total, scored = np.zeros((len(texts), k)), np.zeros(len(texts), np.int64)
        at, chars = 0, 0
        for i, t in enumerate(texts):
            chars += len(t)
            if chars > 400_000 or i == len(texts) - 1:
                self._add(texts[at : i + 1], total[at : i + 1], scored[at : i + 1])
                at, chars = i + 1, 0
        return total / np.maximum(scored, 1)[:, None], scored

    def _add(self, texts: list[str], total: np.ndarray, scored: np.ndarray) -> None:
        c, places, owner = _stream(texts)
        if not len(places):
            return
        keys = _keys(c)
        k = len(self.languages)
        value = np.zeros((len(places), k), np.float32)
        open_ = np.arange(len(places))
        for n in range(ORDER, 0, -1):
            row = self.tables[n].find(keys[n][places[open_]])
            hit = row >= 0
            value[open_[hit]] += self.logp[n][row[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
            if n > 1:
                context = self.tables[n - 1].find(keys[n - 1][places[open_] - 1])
                known = context >= 0
                value[open_[known]] += self.gamma[n - 1][context[known]]
            else:
                value[open_] += self.gamma[0][0] + np.float32(_UNIFORM)
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        total[owner[starts]] -= np.add.reduceat(value, starts, axis=0, dtype=np.float64)
        scored[owner[starts]] += np.diff(np.concatenate([starts, [len(owner)]]))

    def calibrate(self, held: dict[str, list[str]]) -> None:
        """Rejection limits and temperature from texts that were not counted."""
        entropies, truth = [], []
        for j, lang in enumerate(self.languages):
            if held.get(lang):
                e, n = self.cross_entropy(held[lang])
                e = e[n > 0]
                if len(e):
                    self.limit[j] = float(np.quantile(e[:, j], 0.999))
                    self.spread[j] = float(e[:, j].std()) + 0.2
                    entropies.append(e)
                    truth += [j] * len(e)
        if entropies:
            e, truth = np.concatenate(entropies), np.array(truth)
            best = (np.inf, self.temperature)
            for t in (2.0, 4.0, 6.0, 8.0, 12.0, 16.0, 24.0):
                z = -(e - e.min(axis=1, keepdims=True)) * t
                loss = -(z[np.arange(len(e)), truth] - np.log(np.exp(z).sum(axis=1))).mean()
                best = min(best, (loss, t))
            self.temperature = best[1]

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy, rejected."""
        if not self.languages:
            n = len(texts)
            return np.full(n, UNDETERMINED, object), np.zeros(n), np.zeros(n), np.ones(n, bool)
        e, n = self.cross_entropy(texts)
        n[[i for i, t in enumerate(texts) if not any(map(str.isalpha, t or ""))]] = 0  # marks alone are no letters
        best = e.argmin(axis=1)
        own = e[np.arange(len(e)), best]
        score = 1 / np.exp(-(e - own[:, None]) * self.temperature).sum(axis=1)
        rejected = own > self.limit[best] + 4 * self.spread[best] / np.sqrt(np.maximum(n, 1))
        names = np.array(self.languages, object)[best]
        names[n == 0], score[n == 0], rejected[n == 0] = UNDETERMINED, 0.0, True
        return names, score, own, rejected


def training_sample(docs: DataFrame, chars: int = CHARS, total: int = TOTAL_CHARS) -> DataFrame:
    """docs: doc_id, text, lang -> at most ``chars`` characters of each language, in hash order, and ``total`` in all.

    A document gives its first chars / SHARE characters at most, so that no long one fills or ends the sample and every
    language with a labelled text has one in it.
    """
    docs = docs.where("text is not null and text <> '' and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    languages = docs.select("lang").distinct().count()
    most = max(SHARE, min(chars, total // max(1, languages)))
    part = F.substring("text", 1, most // SHARE)
    docs = docs.select("doc_id", part.alias("text"), "lang", F.length(part).alias("_n"), (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)).alias("_u"))
    size = docs.groupBy("lang").agg(F.sum("_n").alias("_all"), F.min("_u").alias("_first"))
    # first a coarse draw of four times the bound, without a shuffle of texts or a sort; then the exact cut inside it
    few = docs.join(F.broadcast(size) if languages <= BROADCAST_LANGUAGES else size, "lang").where((F.col("_u") * F.col("_all") <= 4 * most) | (F.col("_u") == F.col("_first")))
    so_far = F.sum("_n").over(Window.partitionBy("lang").orderBy("_u", "doc_id", "_n", "text").rowsBetween(Window.unboundedPreceding, 0))
    return few.withColumn("_sum", so_far).where(F.col("_sum") <= most).select("doc_id", "text", "lang", "_u")


def fit(docs: DataFrame, chars: int = CHARS) -> Model:
    """docs: doc_id, text, lang.  At most ``chars`` characters a language, and TOTAL_CHARS in all, reach the driver."""
    rows = training_sample(docs, chars).collect()
    rows.sort(key=lambda r: (r["lang"], r["_u"], r["doc_id"], r["text"]))
    count: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for i, r in enumerate(rows):
        (held if i % 5 == 4 else count).setdefault(r["lang"], []).append(r["text"])
    model = Model({lang: count.get(lang, held.get(lang, [])) for lang in {*count, *held}})
    model.calibrate(held)
    return model


def identify(docs: DataFrame, model: Model, reject: bool = True) -> DataFrame:
    """docs: doc_id, text -> doc_id, lang_pred, score, cross_entropy, rejected; with reject, rejected texts are ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in (part for whole in batches for part in common.pieces(whole, 1)):
            names, score, entropy, rejected = own.predict(batch.column(1).to_pylist())
            if reject:
                names[rejected] = UNDETERMINED
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.job(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", "text"), model, reject=False)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
