"""BPE encoding and decoding by a lexicon of frequent words.

The most frequent words, counted over all texts, are compiled with their ids into a minimal acyclic
transducer: words share prefixes and suffixes, and the numbers along a word's path add up to its
place in the table of outputs. Tasks memory-map the compiled lexicon. A word that is not in it is
merged pair by pair, exactly as the tokenizer does.
"""

import hashlib
import heapq
import mmap
import os
import tempfile
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.chunks import Cached, Vocabulary, chunks, kept, load_vocabulary, pieces, pre_tokens, tokenizer_path
from wardline.llm.tasks import map_columns, most_frequent, read, stored, struct_udf

#: Words in the lexicon; also the most words that come to the driver.
WORDS = 1 << 17
#: Bytes up to which a word is merged by looking over all its pairs.
LONG = 100
#: Different words a task counts before it hands its counts on.
COUNTED = 150_000
#: Chunks kept by a worker that also makes the ids themselves, which are large.
KNOWN_WITH_IDS = 150_000
_NONE = 1 << 60


def merge_word(raw: bytes, v: Vocabulary) -> list[int]:
    """Ids of one pre-token: the pair of least rank merges first, the leftmost of equal ones."""
    if len(raw) > LONG:
        return _merge_long(raw, v)
    ids, get = [v.bytes_[b] for b in raw], v.merges.get
    ranks = [get(left << 20 | right, _NONE) for left, right in zip(ids, ids[1:], strict=False)]
    while ranks and (least := min(ranks)) != _NONE:
        k = ranks.index(least)
        ids[k : k + 2] = [least & 0xFFFFF]
        del ranks[k]
        if k:
            ranks[k - 1] = get(ids[k - 1] << 20 | ids[k], _NONE)
        if k < len(ranks):
            ranks[k] = get(ids[k] << 20 | ids[k + 1], _NONE)
    return ids


def _merge_long(raw: bytes, v: Vocabulary) -> list[int]:
    """The same with a heap, for words whose square is too long."""
    ids, get = [v.bytes_[b] for b in raw], v.merges.get
    before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
    heap = [(m, k) for k in range(len(ids) - 1) if (m := get(ids[k] << 20 | ids[k + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        merge, k = heapq.heappop(heap)
        right = after[k]
        if ids[k] < 0 or right >= len(ids) or get(ids[k] << 20 | ids[right]) != merge:
            continue
        ids[k], ids[right], after[k] = merge & 0xFFFFF, -1, after[right]
        if after[k] < len(ids):
            before[after[k]] = k
            if (m := get(ids[k] << 20 | ids[after[k]])) is not None:
                heapq.heappush(heap, (m, k))
        if before[k] >= 0 and (m := get(ids[before[k]] << 20 | ids[k])) is not None:
            heapq.heappush(heap, (m, before[k]))
    return [i for i in ids if i >= 0]


def merge_chunk(chunk: str, v: Vocabulary) -> list[int]:
    return [i for token in pre_tokens(chunk) for i in merge_word(token.encode("utf-8", "surrogatepass"), v)]


class Merger:
    """Merges many words at a time: a row of places for each word, one merge in every row in each round.

    Places stay where they are; each knows the ones before and after it that still hold an id.
    """

    WIDTH = 32
    #: Words up to each of these lengths share an array.
    WIDTHS = (6, 9, 13, 20, WIDTH)

    def __init__(self, v: Vocabulary):
        self.v, self.pairs = v, np.array(sorted(v.merges), np.int64)
        self.merge = np.array([v.merges[k] for k in self.pairs.tolist()], np.int64)
        self.bytes_ = np.array(v.bytes_, np.int64)
        #: ranks of all pairs of bytes, as left << 8 | right
        self.first = self._rank(np.repeat(self.bytes_, 256), np.tile(self.bytes_, 256)) if len(self.pairs) else None

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left << 20 | right
        k = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pairs[k] == want), self.merge[k], _NONE)

    def words(self, raw: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(raw)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        if not len(self.pairs):
            return [merge_word(w, self.v) for w in raw]
        for k in np.flatnonzero(sizes > self.WIDTH).tolist():
            out[k] = merge_word(raw[k], self.v)
        for least, most in zip((0, *self.WIDTHS), self.WIDTHS, strict=False):
            who = np.flatnonzero((sizes > least) & (sizes <= most)).tolist()
            if who:
                for k, ids in zip(who, self._merged([raw[k] for k in who], sizes[who]), strict=True):
                    out[k] = ids
        return out

    def _merged(self, raw: list[bytes], size: np.ndarray) -> list[list[int]]:
        """The ids of words that are not empty. Arrays are flat, a row has one place more than its longest word."""
        n, width = len(raw), int(size.max()) + 1
        place = np.arange(width)
        rows = np.full((n, width), -1, np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        rows[place < size[:, None]] = self.bytes_[flat]
        ranks, inside = np.full((n, width), _NONE, np.int64), np.ones(len(flat), bool)
        inside[np.cumsum(size) - 1] = False
        ranks[place < size[:, None] - 1] = self.first[(flat[:-1] << 8 | flat[1:])[inside[:-1]]]
        ids, rank = rows.reshape(-1), ranks.reshape(-1)
        after = np.arange(1, n * width + 1)
        before = np.arange(-1, n * width - 1)
        before[::width] = -1
        alive = np.arange(n)
        while True:
            best = ranks[alive].argmin(axis=1)
            at = alive * width + best
            merge = rank[at]
            more = merge != _NONE
            alive, at, merge = alive[more], at[more], merge[more]
            if not len(alive):
                break
            right = after[at]
            behind = after[right]
            ids[at], ids[right], rank[right] = merge & 0xFFFFF, -1, _NONE
            after[at], before[behind] = behind, at
            rank[at] = self._rank(ids[at], ids[behind])
            left = before[at]
            inner = left >= 0
            left, at = left[inner], at[inner]
            rank[left] = self._rank(ids[left], ids[at])
        kept = rows >= 0
        flat, ends = rows[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Lexicon:
    """A compiled lexicon over one buffer: arrays of edges and outputs, found by the lengths at its start."""

    FIELDS = ("edge", "target", "add", "final", "at", "ids")

    def __init__(self, buffer):
        sizes, at = np.frombuffer(buffer, np.int64, len(self.FIELDS)), 8 * len(self.FIELDS)
        for name, n in zip(self.FIELDS, sizes, strict=True):
            setattr(self, name, np.frombuffer(buffer, np.int32, int(n), at))
            at += 4 * int(n)

    @staticmethod
    def compile(words: dict[bytes, list[int]]) -> bytes:
        """Adds the words in order and merges each finished suffix with an equal one that is there."""
        order = sorted(words)
        states: list[dict[int, int]] = [{}]
        final = [False]
        merged: dict[tuple, int] = {}
        path: list[tuple[int, int]] = []  # edges of the last word that may still change
        last = b""

        def settle(depth: int) -> None:
            while len(path) > depth:
                parent, byte = path.pop()
                child = states[parent][byte]
                states[parent][byte] = merged.setdefault((final[child], tuple(states[child].items())), child)

        for word in order:
            same = os.path.commonprefix([word, last])
            settle(len(same))
            now = states[path[-1][0]][path[-1][1]] if path else 0
            for byte in word[len(same) :]:
                states.append({})
                final.append(False)
                states[now][byte] = len(states) - 1
                path.append((now, byte))
                now = len(states) - 1
            final[now] = True
            last = word
        settle(0)

        # Renumbered from the start; below[s]: how many words end at or after state s.
        number, stack, below = {0: 0}, [0], {}
        while stack:
            s = stack[-1]
            if todo := [t for t in states[s].values() if t not in below]:
                stack += todo
                continue
            below[s] = int(final[s]) + sum(below[t] for t in states[s].values())
            number.setdefault(s, len(number))
            stack.pop()
        edges = []
        for s, k in number.items():
            passed = int(final[s])
            for byte in sorted(states[s]):
                t = states[s][byte]
                edges.append((k * 256 + byte, number[t], passed))
                passed += below[t]
        edges.sort()
        ends = np.zeros(len(number), np.int64)
        for s, k in number.items():
            ends[k] = final[s]
        outputs = [words[w] for w in order]
        at = np.concatenate(([0], np.cumsum([len(o) for o in outputs]))).astype(np.int64)
        arrays = [np.array([e[j] for e in edges], np.int64) for j in range(3)] + [ends, at, np.array([i for o in outputs for i in o], np.int64)]
        return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.astype(np.int32).tobytes() for a in arrays)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if it is not here; all words walk at the same time."""
        n = np.full(len(words), -1, np.int64)
        if not words or not len(self.edge):
            return n
        sizes = np.array([len(w) for w in words], np.int64)
        flat, begins = np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1]))
        alive, state, total = np.flatnonzero(sizes > 0), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for depth in range(int(sizes.max())):
            want = state[alive] * 256 + flat[begins[alive] + depth]
            k = np.minimum(np.searchsorted(self.edge, want), len(self.edge) - 1)
            alive, k = alive[self.edge[k] == want], k[self.edge[k] == want]
            state[alive], total[alive] = self.target[k], total[alive] + self.add[k]
            done = sizes[alive] == depth + 1
            ended = alive[done]
            n[ended] = np.where(self.final[state[ended]] != 0, total[ended], -1)
            alive = alive[~done]
            if not len(alive):
                break
        return n

    def outputs(self, numbers: np.ndarray) -> list[list[int] | None]:
        """The ids of each word by its number, None for -1."""
        here = numbers[numbers >= 0]
        begins, sizes = self.at[here].astype(np.int64), (self.at[here + 1] - self.at[here]).astype(np.int64)
        ends = np.cumsum(sizes)
        flat = self.ids[np.arange(sizes.sum()) + np.repeat(begins - ends + sizes, sizes)].tolist()
        found = (flat[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True))
        return [next(found) if k else None for k in (numbers >= 0).tolist()]


def mapped(compiled: bytes) -> Lexicon:
    """The lexicon as a memory-mapped file, which leaves the temporary folder with the task that maps it."""
    with tempfile.TemporaryFile() as f:
        f.write(compiled)
        f.flush()
        return Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def word_counts(docs: DataFrame, text: str, added: dict[str, int]) -> DataFrame:
    """`word, n` over all texts; words are chunks with the blank before them."""

    def start():
        counts: Counter[str] = Counter()

        def drained():
            out = list(counts), list(counts.values())
            counts.clear()
            return out

        def step(columns):
            if columns is None:
                return drained() if counts else None
            for x in columns[0]:
                for piece, _ in pieces(x or "", added):
                    counts.update(chunks(piece))
            return drained() if len(counts) > COUNTED else None

        return step

    counted = map_columns(docs.select(F.col(text)), "word string, n long", start, finish=True)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", words: int = WORDS) -> bytes:
    """The most frequent words of all texts, at most `words`, compiled. Only these come to the driver.

    Words of more than 64 characters are left to merging, which keeps the lexicon's size bounded.
    """
    counted = stored(word_counts(docs, text, vocabulary.added).where((F.col("n") > 1) & (F.length("word") <= 64)), "words")
    top = most_frequent(counted, words).select("word").collect()
    return Lexicon.compile({r["word"].encode(): merge_chunk(r["word"], vocabulary) for r in top})


def encoder(vocabulary: Vocabulary, compiled: bytes, most: int | None = None) -> Cached:
    """Chunks by the lexicon; what it does not have is cut to pre-tokens, which it may have, or which are merged.

    A chunk comes to its ids in decimal, comma-joined, and to what they decode to. Both are made once
    for a chunk; texts join them. A chunk that decodes to itself is not held twice.
    """
    lexicon, merger, tokens = mapped(compiled), Merger(vocabulary), vocabulary.tokens
    decimal = [str(i) for i in range(len(tokens))]
    lengths = np.array([len(t) for t in tokens], np.int64)

    def listed(ids: list[int]) -> str:
        return ",".join(map(decimal.__getitem__, ids))

    def decoded(ids: list[int]) -> str:
        return b"".join(map(tokens.__getitem__, ids)).decode("utf-8", "replace")

    def themselves(raw: list[bytes], ids: list[list[int]]) -> bool:
        """Whether the ids of each chunk decode to it: all of them to all chunks, and each to as many bytes."""
        flat = list(chain.from_iterable(ids))
        whole = b"".join(raw)
        if b"".join(map(tokens.__getitem__, flat)) != whole or whole.decode("utf-8", "replace").encode() != whole:
            return False
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        return np.array_equal(np.cumsum(lengths[flat])[ends - 1], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))))

    def look_up(raw: list[bytes]) -> list[list[int] | None]:
        return lexicon.outputs(lexicon.find(raw))

    def encode_new(new: list[str]) -> list[tuple[str, str]]:
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        out = look_up(raw)
        cut = {k: pre_tokens(new[k]) for k, ids in enumerate(out) if ids is None}
        parts = {t: t.encode("utf-8", "surrogatepass") for ts in cut.values() for t in ts}
        known = dict(zip(parts, look_up(list(parts.values())), strict=True))
        unseen = [t for t, ids in known.items() if ids is None]
        known.update(zip(unseen, merger.words([parts[t] for t in unseen]), strict=True))
        for k, ts in cut.items():
            out[k] = known[ts[0]] if len(ts) == 1 else [i for t in ts for i in known[t]]
        if themselves(raw, out):
            return list(zip(map(listed, out), new, strict=True))
        back = map(decoded, out)
        return [(listed(ids), c if b == c else b) for ids, b, c in zip(out, back, new, strict=True)]

    return Cached(encode_new, vocabulary.added, lambda k: (listed([k]), decoded([k])), most)


def _encoding(docs: DataFrame, vocabulary: Vocabulary, compiled: bytes, with_ids: bool):
    """For tasks: a function from texts to the lists of the fields that `encode` names."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, compiled))

    def start():
        v, lexicon = shared.value
        most = KNOWN_WITH_IDS if with_ids else None
        cached = kept(f"{hashlib.sha256(lexicon).hexdigest()} {most}", lambda: encoder(v, lexicon, most))

        def step(texts):
            n, hashes, decoded, all_ids = [], [], [], []
            for parts in cached.encode([t or "" for t in texts]):
                ids = ",".join([p[0] for p in parts])
                n.append(ids.count(",") + 1 if ids else 0)
                hashes.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256("".join([p[1] for p in parts]).encode("utf-8", "replace")).hexdigest())
                if with_ids:
                    all_ids.append(np.fromstring(ids, np.int32, sep=",") if ids else np.zeros(0, np.int32))
            return (n, hashes, decoded, all_ids) if with_ids else (n, hashes, decoded)

        return step

    return start


_FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, vocabulary: Vocabulary, compiled: bytes, text: str = "text"):
    """A struct of `n_tokens, ids_sha256, decoded_sha256` for each text.

    The text is encoded, and its ids are decoded again. A null text counts as empty: no ids, and the
    hashes of nothing. Equal texts have equal results.
    """
    return struct_udf(_FIELDS, _encoding(docs, vocabulary, compiled, False))(F.col(text))


def encode_with_ids(docs: DataFrame, vocabulary: Vocabulary, compiled: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`<key>`, the same fields and `ids` for each row. Ids leave the worker a few texts at a time."""
    encoding = _encoding(docs, vocabulary, compiled, True)

    def start():
        step = encoding()
        return lambda columns: (columns[0], *step(columns[1]))

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {_FIELDS}, ids array<int>"
    return map_columns(docs.select(key, text), schema, start)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = read(spark, sf_dir, "documents").select("doc_id", "text"), load_vocabulary(tokenizer_path())
    out = docs.select("doc_id", encode(docs, vocabulary, build_lexicon(docs, vocabulary)).alias("e"))
    return out.select("doc_id", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with the hashes of the ids and of what they decode to."""
    vocabulary = load_vocabulary(tokenizer_path())
    out = encode_with_ids(docs, vocabulary, build_lexicon(docs, vocabulary))
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")
