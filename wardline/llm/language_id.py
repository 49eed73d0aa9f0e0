"""Language identification with error-correcting output codes.

Each language has a codeword. A binary classifier for each bit tells, from hashed byte n-grams,
the languages whose bit is set from the others. Decoding weighs the losses of the bits and takes
the nearest codeword; a text near two codewords is flagged.
"""

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import map_columns, read, residue, struct_udf

FEATURES = 1 << 14
#: Each language's table of counts is brought to the driver, so there is a bound on their number.
MAX_LANGUAGES = 512
#: A text is ambiguous if the second codeword takes more than this share of what the first has.
AMBIGUOUS = 0.5
UNKNOWN = "und"

_OTHER = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


class Model(NamedTuple):
    languages: list[str]
    #: languages x bits, each 1 or -1
    codes: np.ndarray
    #: features x bits: log odds that the bit is set
    weights: np.ndarray
    #: how well each bit tells its two groups apart on average
    trust: np.ndarray


def features(text: str) -> np.ndarray:
    """Counts of the byte bigrams and trigrams of letters, white space and punctuation as one."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(_OTHER) + b" ", np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(0x9E3779B1) ^ b[1:] * np.uint32(0x85EBCA77)
    three = (two[:-1] * np.uint32(5)) ^ b[2:] * np.uint32(0xC2B2AE3D)
    hashed = np.concatenate((two * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1))) >> np.uint32(18)
    return np.bincount(hashed, minlength=FEATURES).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """`n` rows of 1 and -1, any two of which differ in half of the bits, in columns that tell rows apart."""
    order = 16
    while order < n:
        order *= 2
    signs = np.array([[1 - 2 * ((i & j).bit_count() & 1) for j in range(order)] for i in range(n)], dtype=np.int8).reshape(n, order)
    return signs[:, [j for j in range(order) if n and abs(int(signs[:, j].sum())) < n]]


def language_counts(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """`lang, feature, n` over all labelled rows: counted in each task, then added up."""

    def start():
        counts: dict[str, np.ndarray] = {}

        def drained():
            rows = [(k, np.flatnonzero(v), v) for k, v in counts.items()]
            out = ([k for k, at, _ in rows for _ in at], np.concatenate([at for _, at, _ in rows]).tolist(), np.concatenate([v[at] for _, at, v in rows]).tolist())
            counts.clear()
            return out

        def step(columns):
            if columns is None:
                return drained() if counts else None
            for x, k in zip(*columns, strict=True):
                if k not in counts:
                    counts[k] = np.zeros(FEATURES)
                counts[k] += features(x)
            return drained() if len(counts) > 64 else None

        return step

    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counted = map_columns(usable.select(F.col(text), F.col(lang)), "lang string, feature int, n double", start, finish=True)
    return counted.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learns from all rows with a text with letters and a language.

    What comes to the driver is one table of counts per language, of a fixed size each. No usable
    row gives a model without languages, which predicts `und` only.
    """
    counted = language_counts(labelled, text, lang)
    rows = counted.groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("table")).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows.sort(key=lambda r: r["lang"])
    share = np.zeros((len(rows), FEATURES))
    for k, r in enumerate(rows):
        for f, n in r["table"]:
            share[k, f] = n
    share = (share + 0.05) / (share.sum(axis=1, keepdims=True) + 0.05 * FEATURES) if len(rows) else share
    codes = codewords(len(rows))
    weights, trust = np.zeros((FEATURES, codes.shape[1]), np.float32), np.zeros(codes.shape[1])
    for b in range(codes.shape[1]):
        one, other = share[codes[:, b] > 0].mean(axis=0), share[codes[:, b] < 0].mean(axis=0)
        odds = np.log(one) - np.log(other)
        weights[:, b], trust[b] = odds, ((one - other) * odds).sum()
    return Model([r["lang"] for r in rows], codes, weights, trust / trust.sum() if trust.sum() else trust)


def predict(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct of `lang_pred, score, second, ambiguous` for each text.

    `und` with score 0 for a null text, a text without a letter, or a model without languages. Equal
    texts have equal results, ties go to the first language by name.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        languages, codes, weights, trust = shared.value
        signs = codes.astype(np.float64)

        def step(texts):
            n = len(texts)
            pred, score, second, doubt = [UNKNOWN] * n, [0.0] * n, [None] * n, [False] * n
            known = [i for i in range(n) if languages and texts[i] and any(map(str.isalpha, texts[i]))]
            if not known:
                return pred, score, second, doubt
            counts = np.stack([features(texts[i]) for i in known])
            size = counts.sum(axis=1, keepdims=True)
            margin = (counts @ weights) / size
            # Evidence grows with a text's length, up to what a short paragraph has.
            loss = np.logaddexp(0, -margin[:, None, :] * signs[None] * np.minimum(size, 256)[:, :, None] / 8) @ trust if signs.shape[1] else np.zeros((len(known), 1))
            near = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
            order = np.argsort(loss, axis=1, kind="stable")
            for row, i in enumerate(known):
                best = order[row, 0]
                pred[i], score[i] = languages[best], float(near[row, best] / near[row].sum())
                if len(languages) > 1:
                    second[i] = languages[order[row, 1]]
                    doubt[i] = bool(near[row, order[row, 1]] > AMBIGUOUS)
            return pred, score, second, doubt

        return step

    return struct_udf("lang_pred string, score double, second string, ambiguous boolean", start)(F.col(text))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.where(residue("doc_id", 3) != 1))
    out = docs.select("doc_id", (residue("doc_id", 3) == 1).alias("held_out"), predict(docs, model).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.second", "p.ambiguous")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which no language is recognised; the others stay as they are. Where nothing could be learned, all stay."""
    model = fit(docs)
    if not model.languages:
        return docs
    judged = docs.select("*", predict(docs, model).alias("__language"))
    return judged.where(F.col("__language.lang_pred") != UNKNOWN).select(*docs.columns)
