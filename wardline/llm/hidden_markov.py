"""Language-model scoring by a hidden Markov model.

States are latent and emit classes of words: each of the most frequent words is a class, all others
are classed by their ending. Within its class a word has its smoothed share of the counts over the
whole training text, so the model gives every text a probability, however many words there are:

    P(text) = P(classes of the words and the end | model) * product of P(word | class)

The model starts from random states; every pass of Baum-Welch runs over the whole training text, its
expected counts are made in each partition and added up, until the likelihood settles. The likelihood of
a sequence comes exactly from the forward recursion, scaled in each step.
"""

import zlib
from collections import Counter
from itertools import repeat
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import map_columns, most_frequent, read, residue, stored, words

STATES = 8
#: Frequent words that are a class of their own, and classes by ending for the rest.
OWN_CLASSES, TAILS = 8192, 2048
#: Words whose counts tasks have at hand; the rest are looked up by a join.
AT_HAND = 1 << 17
#: Words in a training sequence (longer texts are several).
WINDOW = 512
#: The likelihood has settled if a pass raises its logarithm by at most this part.
SETTLED = 1e-4
#: Words whose forward recursion runs at the same time, and different words counted before they are handed on.
TOGETHER, COUNTED = 2_000_000, 200_000

_SEED = 20_001
_END = ""


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-4:]) % TAILS


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """`word, tail, n` over all texts; the empty word counts the ends."""

    def start():
        counts: Counter[bytes] = Counter()

        def drained():
            out = [w.decode() for w in counts], [tail_class(w) for w in counts], list(counts.values())
            counts.clear()
            return out

        def step(columns):
            if columns is None:
                return drained() if counts else None
            for x in columns[0]:
                counts.update(words(x))
            counts[b""] += len(columns[0])
            return drained() if len(counts) > COUNTED else None

        return step

    counted = map_columns(docs.select(F.col(text)), "word string, tail int, n long", start, finish=True)
    return counted.groupBy("word", "tail").agg(F.sum("n").alias("n"))


class Words(NamedTuple):
    """What tasks know of words: a bounded part of the counts, and the sums of every class."""

    #: word to its place in the next two; the last place is that of no word
    at_hand: dict[bytes, int]
    #: classes and counts; classes of their own come first, then the tails
    classes: np.ndarray
    counts: np.ndarray
    own: int
    total: int
    different: int
    #: tokens and different words of each class
    n_class: np.ndarray
    v_class: np.ndarray


def gather_words(counts: DataFrame) -> Words:
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    top = sorted(most_frequent(counts, AT_HAND).collect(), key=lambda r: (r["word"] != _END, -r["n"], r["word"]))
    own = min(OWN_CLASSES, len(top))
    at_hand = {r["word"].encode(): k for k, r in enumerate(top)}
    classes = np.array([*(k if k < own else own + r["tail"] for k, r in enumerate(top)), 0], np.int32)
    held = np.array([*(r["n"] for r in top), 0], np.int64)
    n_class, v_class = np.zeros(own + TAILS), np.zeros(own + TAILS)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        n_class[own + r["tail"]], v_class[own + r["tail"]] = r["n"], r["v"]
    for k, r in enumerate(top[:own]):
        n_class[k], v_class[k] = r["n"], 1
        n_class[own + r["tail"]] -= r["n"]
        v_class[own + r["tail"]] -= 1
    return Words(at_hand, classes, held, own, sums["n"] or 0, sums["v"], n_class, v_class)


def looked_up(tokens: list[bytes], known: Words) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Classes of tokens; the places of those that are at hand; and the others, as often as they occur."""
    at = np.fromiter(map(known.at_hand.get, tokens, repeat(-1)), np.int64, len(tokens))
    ids, missing = known.classes[at], np.flatnonzero(at < 0)
    others = [tokens[k] for k in missing.tolist()]
    ids[missing] = [known.own + tail_class(x) for x in others]
    return ids, at[at >= 0], others


def class_ids(w: list[bytes], known: Words) -> np.ndarray:
    """Classes of the words of a text and of its end."""
    return looked_up([*w, b""], known)[0]


class Model(NamedTuple):
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def model_of(start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
    """From expected counts; each state keeps a small part of the classes' overall shares."""
    return Model(_normal(start + 0.1), _normal(move + 0.1), _normal(emit + share * (1.0 + 0.001 * emit.sum(axis=1, keepdims=True))))


class Steps(NamedTuple):
    """Sequences side by side, the longest first: what all have at a step lies together."""

    #: the sequences in this order; where each step begins, and the last ends
    order: np.ndarray
    at: list[int]
    #: the classes, step by step
    seen: np.ndarray


def steps_of(rows: list[np.ndarray]) -> Steps:
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    order = np.argsort(-size, kind="stable")
    size = size[order]
    at = np.concatenate(([0], np.cumsum(np.searchsorted(-size, -np.arange(int(size[0])))))).astype(np.int64)
    flat = np.concatenate([rows[k] for k in order.tolist()])
    step = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    seen = np.empty_like(flat)
    seen[at[step] + np.repeat(np.arange(len(rows)), size)] = flat
    return Steps(order, at.tolist(), seen)


def expected_counts(rows: list[np.ndarray], firsts: list[bool], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch: expected starts, moves and emissions of sequences of classes, and their log likelihood.

    A sequence that continues a text starts as states are spread overall, and with the last word of
    the one before: that word is counted there, the move from it here. Arrays have a row for each state.
    """
    order, at, seen = steps_of(rows)
    n, states = len(rows), len(model.start)
    overall = np.linalg.matrix_power(model.move, 64).mean(axis=0)
    first = np.array(firsts, bool)[order]
    move = model.move.astype(np.float32)
    back = np.ascontiguousarray(move.T)
    emit = np.empty((states, len(seen)), np.float32)
    for row, by_class in zip(emit, model.emit.astype(np.float32), strict=True):
        np.take(by_class, seen, out=row, mode="clip")
    alpha, scale = np.empty_like(emit), np.empty(len(seen), np.float32)
    now = np.where(first, model.start[:, None], overall[:, None]).astype(np.float32)
    for t, (a, b) in enumerate(zip(at, at[1:], strict=False)):
        to = alpha[:, a:b]
        np.multiply(back @ now[:, : b - a] if t else now, emit[:, a:b], out=to)
        np.add.reduce(to, axis=0, out=scale[a:b])
        to /= scale[a:b]
        now = to
    # Behind a step, alpha becomes the probabilities of the states, and emit what lies between it and the step before.
    moves, beta = np.zeros((states, states)), np.ones((states, n), np.float32)
    for t in range(len(at) - 2, 0, -1):
        a, b = at[t], at[t + 1]
        alpha[:, a:b] *= beta[:, : b - a]
        onward = emit[:, a:b]
        onward *= beta[:, : b - a]
        onward /= scale[a:b]
        moves += alpha[:, at[t - 1] : at[t - 1] + b - a] @ onward.T
        np.matmul(move, onward, out=beta[:, : b - a])
    alpha[:, :n] *= beta
    starts = alpha[:, :n][:, first].sum(axis=1, dtype=np.float64)
    alpha[:, :n][:, ~first] = 0
    scale[:n][~first] = 1
    counts = np.array([np.bincount(seen, weight, model.emit.shape[1]) for weight in alpha])
    return starts, moves * model.move, counts, float(np.log10(scale, dtype=np.float64).sum())


def _first_model(share: np.ndarray) -> Model:
    """Random states: each prefers classes of its own, however large the corpus is."""
    emit = np.random.default_rng(_SEED).random((STATES, len(share))) * share
    return model_of(np.ones(STATES), np.ones((STATES, STATES)) + 40 * np.eye(STATES), emit * len(share), share)


def training_sequences(docs: DataFrame, text: str, known) -> DataFrame:
    """`first, classes` (16-bit numbers): the texts in windows of WINDOW words, behind the last word of the window before."""

    def start():
        w = known.value

        def step(columns):
            out = []
            for x in columns[0]:
                ids = class_ids(words(x), w).astype("<u2")
                out += [(at == 0, ids[max(at - 1, 0) : at + WINDOW].tobytes()) for at in range(0, len(ids), WINDOW)]
            return list(zip(*out, strict=True)) if out else None

        return step

    return map_columns(docs.select(F.col(text)), "first boolean, classes binary", start)


def baum_welch(sequences: DataFrame, model: Model, share: np.ndarray) -> tuple[Model, float]:
    """One pass over all sequences: counts made in each partition, added up by Spark, a bounded table to the driver.

    Returns the next model and the log likelihood under the given one.
    """
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    n_class = len(share)

    def start():
        held, sums = [], []

        def flush():
            if held:
                made = expected_counts([np.frombuffer(c, "<u2").astype(np.int64) for _, c in held], [f for f, _ in held], shared.value)
                sums[:] = [a + b for a, b in zip(sums, made, strict=True)] if sums else made
                held.clear()

        def step(columns):
            if columns is not None:
                held.extend(zip(*columns, strict=True))
                if len(held) >= 1024:
                    flush()
                return None
            flush()
            if not sums:
                return None
            flat = np.concatenate([np.ravel(x) for x in sums])
            at = np.flatnonzero(flat)
            return at, flat[at]

        return step

    counted = map_columns(sequences, "cell int, n double", start, finish=True).groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(STATES + STATES * STATES + STATES * n_class + 1)
    summed = counted.toArrow()
    flat[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    starts, moves, emits = np.split(flat[:-1], [STATES, STATES + STATES * STATES])
    return model_of(starts, moves.reshape(STATES, STATES), emits.reshape(STATES, n_class), share), float(flat[-1])


def train(docs: DataFrame, text: str, counts: DataFrame) -> tuple[Words, Model]:
    known = gather_words(counts)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    sequences = stored(training_sequences(docs, text, shared), "sequences")
    share = _normal(known.n_class + 0.01)
    model, before = baum_welch(sequences, _first_model(share), share)
    while True:
        model, like = baum_welch(sequences, model, share)
        if not like - before > SETTLED * abs(like):
            break
        before = like
    return known, model


def log_likelihoods(rows: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 of the probability of each sequence: the forward recursion over all at a time, the longest first."""
    order, at, seen = steps_of(rows)
    back, scale = np.ascontiguousarray(model.move.T), np.empty(len(seen))
    now = np.tile(model.start[:, None], len(rows))
    for t, (a, b) in enumerate(zip(at, at[1:], strict=False)):
        now = (back @ now[:, : b - a] if t else now) * model.emit[:, seen[a:b]]
        np.add.reduce(now, axis=0, out=scale[a:b])
        now /= scale[a:b]
    np.log10(scale, out=scale)
    out = np.empty(len(rows))
    out[order] = np.bincount(np.arange(len(seen)) - np.repeat(at[:-1], np.diff(at)), scale, len(rows))
    return out


def score(docs: DataFrame, known: Words, model: Model, counts: DataFrame, key: str, text: str, extra: list) -> DataFrame:
    """Per row of `docs`: key, `extra` columns, n_tokens, n_known, base_score and score.

    Words that tasks do not have at hand are looked up in `counts` by a join; of those only
    log10(count + 1) and whether there is one are missing, which are added up by document.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, model))

    def start():
        w, m = shared.value
        floor = np.log10(w.total + w.different + 1)
        in_class = np.log10(w.n_class + w.v_class + 1)
        logs = np.log10(w.counts + 1.0)
        held: list[tuple] = []
        size = [0]

        def flush():
            if not held:
                return None
            likes = log_likelihoods([h[0] for h in held], m).tolist()
            rows = [(*row, n, known, log - n * floor, log + like - within, word, times) for (_, row, n, known, log, within, word, times), like in zip(held, likes, strict=True)]
            held.clear()
            size[0] = 0
            return list(zip(*rows, strict=True))

        def step(columns):
            if columns is None:
                return flush()
            *row, texts = columns
            for r, x in zip(zip(*row, strict=True), texts, strict=True):
                ids, at, others = looked_up([*words(x), b""], w)
                rare = Counter(others)
                held.append((ids, r, len(ids), len(at), float(logs[at].sum()), float(in_class[ids].sum()), [k.decode() for k in rare], list(rare.values())))
                size[0] += len(ids)
            return flush() if size[0] > TOGETHER else None

        return step

    picked = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("row"), F.col(key).alias("key"), *extra, F.col(text).alias("text"))
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    made = map_columns(picked, f"{head}, n_tokens long, n_known long, base double, score double, word array<string>, times array<long>", start, finish=True)
    # A row for each document itself (its word is one that no text has), and one for each rare word.
    group = picked.columns[:-1]
    itself = F.struct(F.concat(F.lit(" "), F.col("row").cast("string")).alias("word"), F.lit(None).cast("long").alias("times"))
    apart = made.select(*group, "n_tokens", "n_known", "base", "score", F.explode(F.concat(F.array(itself), F.arrays_zip("word", "times"))).alias("r")).select(*group, "n_tokens", "n_known", "base", "score", "r.*")
    met = apart.join(counts.select("word", "n"), "word", "left")
    own, log = F.col("times").isNull(), F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)
    summed = met.groupBy(*group).agg(
        F.sum(own.cast("long")).alias("copies"), F.max("n_tokens").alias("n_tokens"),
        F.max("n_known").alias("known"), F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("more"),
        F.max("base").alias("base"), F.max("score").alias("score"), F.sum(log).alias("logs"),
    )
    each = F.coalesce(F.col("logs"), F.lit(0.0)) / F.col("copies")
    more = F.coalesce((F.col("more") / F.col("copies")).cast("long"), F.lit(0))
    out = summed.select(*group, "n_tokens", (F.col("known") + more).alias("n_known"), (F.col("base") + each).alias("base_score"), (F.col("score") + each).alias("score"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.drop("row", "copy").withColumnRenamed("key", key)


def score_documents(docs: DataFrame, trains, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Trains on the rows where the condition `trains` holds and scores all.

    Returns `<key>, held_out, n_tokens, n_known, train_tokens, base_score, score`, a row for each row
    of `docs`; rows with equal key and text get equal values. A null text counts as empty: its end is
    its only token. Without any training row all counts are 0 and states alike. Null keys are kept.
    """
    marked = docs.select(F.col(key), F.col(text), F.coalesce(~trains, F.lit(True)).alias("held_out"))
    training = marked.where(~F.col("held_out"))
    counts = stored(word_counts(training, text), "counts")
    known, model = train(training, text, counts)
    scored = score(marked, known, model, counts, key, text, ["held_out"])
    return scored.select(key, "held_out", "n_tokens", "n_known", F.lit(known.total).cast("long").alias("train_tokens"), "base_score", "score")


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), residue("doc_id", 7) != 2)
