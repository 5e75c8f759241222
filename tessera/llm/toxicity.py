"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps every code point to one other: case is dropped, homoglyphs (Cyrillic, Greek, full width,
mathematical and accented Latin look-alikes that share a decomposition) become their Latin letter and
digits and signs inside a word become the letter they stand for (``1d10t`` -> ``idiot``).
Entries match whole words, or word starts if they end in ``*``; a hit that lies inside an exception
phrase doesn't count.

Weights come from labels: for words and word starts of a bounded, documented sample of labelled
documents (the SAMPLE rows with the smallest hash), the smoothed log odds of being in a toxic
document; entries need enough toxic documents and a high ratio.  Two features of a text, log(1 +
weight) and log(1 + weight per LENGTH words), go into a logistic function fitted on the same sample.

Null, empty and wordless texts score as texts without a hit.  Labels other than 0 and 1 are ignored; without any
positive or any negative label the built-in seed lexicon is used with preset weights.  Repeated rows are scored each.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

#: Labelled rows that the lexicon is learned from, at most.
SAMPLE = 12_000
#: Lexicon entries, at most; the strongest stay.
MAX_ENTRIES = 5_000
#: Words that half of the weight of one hit is spread over.
LENGTH = 100.0

#: Characters folded at once.
RUN = 400_000

SEED_LEXICON = {"idiot": 4.0, "moron": 4.0, "stupid": 3.0, "scum": 4.0, "trash": 2.0, "pathetic": 2.5, "worthless": 3.0, "disgusting": 2.5, "loser": 3.0, "clown": 2.0}
#: A hit inside one of these is not one.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown fish", "clown fish", "stupid question", "loser bracket")

_LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ӏ": "l", "ո": "n", "ս": "u", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ſ": "s",
}
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
_BREAKS = "!|"  # these stand for a letter only between letters


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code point -> folded code point; -> letter that a digit or sign stands for (else 0); -> is a letter."""
    n = 0x110000
    fold, letter, sign = np.arange(n, dtype=np.uint32), np.zeros(n, bool), np.zeros(n, np.uint32)
    for c in [*range(0x0, 0x2000), *range(0x2100, 0x2190), *range(0xFB00, 0xFB07), *range(0xFF00, 0xFF60), *range(0x1D400, 0x1D800)]:
        ch = chr(c)
        low = unicodedata.normalize("NFKC", ch).casefold()
        low = low if len(low) == 1 else ch.lower() if len(ch.lower()) == 1 else ch
        fold[c] = ord(_LOOK_ALIKE.get(low, low))
    for c in range(0, 0x30000):
        letter[c] = chr(c).isalpha()
    for k, v in _STANDS_FOR.items():
        sign[ord(k)] = ord(v)
    return fold, sign, letter


def fold_texts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts folded into one string with a newline after each; start of each text; which places are letters."""
    fold, sign, letter = _tables()
    raw = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = fold[raw]
    is_letter = letter[out]
    stands = sign[out]
    if stands.any():
        # a digit or sign counts as a letter next to one: "id10t", "1diot"; "!" and "|" only between two
        places = np.flatnonzero(stands)
        # letters before and after the run of signs
        edge = np.flatnonzero(np.concatenate([[True], np.diff(places) > 1]))
        run = np.repeat(np.arange(len(edge)), np.diff(np.concatenate([edge, [len(places)]])))
        first, last = places[edge], places[np.concatenate([edge[1:] - 1, [len(places) - 1]])]
        before = is_letter[np.maximum(first - 1, 0)] & (first > 0)
        after = is_letter[np.minimum(last + 1, len(out) - 1)]
        hard = np.isin(raw[places], [ord(c) for c in _BREAKS])
        ok = np.where(hard, (before & after)[run], (before | after)[run])
        places = places[ok]
        out[places] = stands[places]
        is_letter = is_letter.copy()
        is_letter[places] = True
    return out.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), starts, is_letter


@functools.lru_cache(maxsize=4)
def _automaton(entries: str, exceptions: str):
    import ahocorasick

    auto = ahocorasick.Automaton()
    for word, weight in json.loads(entries).items():
        auto.add_word(word.rstrip("*"), (len(word.rstrip("*")), weight, word.endswith("*"), False))
    for phrase in json.loads(exceptions):
        auto.add_word(phrase, (len(phrase), 0.0, False, True))
    auto.make_automaton()
    return auto


def lexicon_weights(texts: list[str | None], entries: str, exceptions: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed weight, number of hits and number of words (runs of letters) of each text."""
    texts = [t or "" for t in texts]
    weight, hits, words = np.zeros(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    if not texts:
        return weight, hits, words
    text, starts, is_letter = fold_texts(texts)
    began = np.flatnonzero(is_letter & ~np.concatenate([[False], is_letter[:-1]]))
    np.add.at(words, np.searchsorted(starts, began, side="right") - 1, 1)
    auto = _automaton(entries, exceptions)
    if not len(auto):
        return weight, hits, words
    found: dict[int, tuple[float, int]] = {}  # start -> (weight, end): the longest entry that begins at a word
    spared: list[tuple[int, int]] = []
    for end, (size, w, prefix, exception) in auto.iter(text):
        at = end - size + 1
        if (at and is_letter[at - 1]) or (not prefix and is_letter[end + 1]):
            continue
        if exception:
            spared.append((at, end))
        elif at not in found or found[at][1] < end:
            found[at] = (w, end)
    for at, end in spared:
        for x in [x for x in range(at, end + 1) if x in found and found[x][1] <= end]:
            del found[x]
    if found:
        at = np.fromiter(found, np.int64, len(found))
        own = np.searchsorted(starts, at, side="right") - 1
        np.add.at(weight, own, np.array([w for w, _ in found.values()]))
        np.add.at(hits, own, 1)
    return weight, hits, words


def _features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.log1p(weight), np.log1p(weight * LENGTH / np.maximum(words, LENGTH)), np.ones(len(weight))], axis=1)


class Model:
    """Lexicon, exceptions and the three coefficients; small, so it travels with the tasks."""

    def __init__(self, entries: dict[str, float], exceptions=EXCEPTIONS, coefficients=(3.0, 1.0, -4.0)):
        self.entries, self.exceptions, self.coefficients = json.dumps(entries), json.dumps(list(exceptions)), np.array(coefficients)

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and hits; texts are folded in runs of about RUN characters, so memory follows the longest text, not the batch."""
        score, hits = [np.zeros(0)], [np.zeros(0, np.int64)]
        at = chars = 0
        for i, t in enumerate(texts):
            chars += len(t or "")
            if chars >= RUN or i == len(texts) - 1:
                weight, n, words = lexicon_weights(texts[at : i + 1], self.entries, self.exceptions)
                score.append(1 / (1 + np.exp(-np.clip(_features(weight, words) @ self.coefficients, -30, 30))))
                hits.append(n)
                at, chars = i + 1, 0
        return np.concatenate(score), np.concatenate(hits)


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) -> documents that hold a word (w) or a word that starts so (w*), by label; a sum a task."""
    counts: dict[str, list[int]] = {}
    for batch in (part for whole in batches for part in common.pieces(whole)):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            folded, _, is_letter = fold_texts([text or ""])
            change = np.flatnonzero(np.diff(np.concatenate([[False], is_letter]).astype(np.int8)))
            words = {folded[a:b] for a, b in zip(change[::2].tolist(), change[1::2].tolist(), strict=False) if 3 <= b - a <= 40}
            stems = {w[:k] + "*" for w in words for k in range(5, min(len(w), 9))}
            for w in words | stems:
                counts.setdefault(w, [0, 0])[toxic] += 1
    keys = list(counts)
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[k][1] for k in keys], pa.int64()), pa.array([counts[k][0] for k in keys], pa.int64())], names=["entry", "toxic", "clean"])


def fit(labelled: DataFrame, sample: int = SAMPLE, min_docs: int = 8, max_entries: int = MAX_ENTRIES) -> Model:
    """labelled: doc_id, text, toxic (0 or 1; all else is ignored).  Reads at most ``sample`` rows, picked by hash."""
    spark = labelled.sparkSession
    labelled = labelled.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    if labelled.count() > sample:  # the sample is drawn before texts move
        ids = labelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        labelled = labelled.join(F.broadcast(ids), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = labelled.select("text", "toxic")
    picked = common.cut(picked.repartition(common.shuffle_partitions(spark)))
    n = {int(r["toxic"]): r["count"] for r in picked.groupBy("toxic").count().collect()}
    nt, nc = n.get(1, 0), n.get(0, 0)
    if not nt or not nc:
        return Model(SEED_LEXICON)
    counted = picked.mapInArrow(_count_stems, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (nt + 1)) - F.log((F.col("clean") + 0.5) / (nc + 1))
    rows = counted.where(F.col("toxic") >= min_docs).withColumn("w", odds).where("w > 2.5 and toxic > clean").orderBy(F.desc(F.col("w") * F.sqrt("toxic")), "entry").limit(max_entries).collect()
    strength = {r["entry"]: (r["toxic"], r["clean"], r["w"]) for r in rows}
    entries = {}
    for entry, (toxic, _, w) in strength.items():
        # a shorter stem that holds this entry and is as pure stands for it
        body = entry.rstrip("*")
        shorter = [body[:k] + "*" for k in range(5, len(body) + (0 if entry.endswith("*") else 1))]
        if any(s in strength and s != entry and strength[s][0] >= 1.3 * toxic and strength[s][2] >= w - 1.0 for s in shorter):
            continue
        if entry.endswith("*") and body in strength and strength[body][0] >= 0.95 * toxic:
            continue  # the word alone explains the stem
        entries[entry] = round(min(w, 6.0), 3)
    entries = {k: v for k, v in SEED_LEXICON.items() if k not in entries} | entries
    model = Model(entries)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in common.pieces(whole)):
            weight, _, words = lexicon_weights(batch.column(0).to_pylist(), model.entries, model.exceptions)
            yield pa.RecordBatch.from_arrays([pa.array(weight), pa.array(words), batch.column(1).cast(pa.int64())], names=["weight", "words", "toxic"])

    seen = picked.mapInArrow(featured, "weight double, words long, toxic long").toPandas()
    x, y = _features(seen["weight"].to_numpy(), seen["words"].to_numpy()), seen["toxic"].to_numpy()
    beta = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.coefficients = beta
    return model


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """docs: doc_id, text -> doc_id, score (0 to 1), predicted (1 if score >= 0.5), n_hits.  Every row, repeated ones too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in common.pieces(batch, 1):
                score, hits = model.score(own.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(hits)], names=["doc_id", "score", "predicted", "n_hits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int, n_hits long")


def labelled_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxic label outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic in (0, 1)").select(F.col("doc_id").alias("_id"), "toxic")
    labels = labels.where(F.crc32(F.col("_id").cast("string")) % 5 != 0)
    # the sample is drawn before texts are read: no text outside it moves
    labels = labels.withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(SAMPLE).drop("_h")
    return docs.select("doc_id", "text").join(F.broadcast(labels), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of docs that the model doesn't call toxic, all columns."""

    @F.pandas_udf("boolean")
    def clean(texts):
        score, _ = model.score(texts.where(texts.notna(), None).tolist())
        import pandas as pd

        return pd.Series(score < 0.5)

    return docs.where(clean(F.col("text").cast("string")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.job(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(labelled_documents(spark, docs, sf_dir))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")
    return score_documents(docs, model).select("doc_id", held_out, "score", "predicted", "n_hits")
