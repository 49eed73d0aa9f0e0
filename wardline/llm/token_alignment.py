"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A (byte-level BPE) tells character offsets, tokenizer B (pieces with byte fallback) tells
spans of bytes. Both are coarse: tokens that share a character have one offset, byte tokens have empty
spans. There the decoded bytes of the tokens decide. Offsets where tokens of both end cut a text into
groups, and the tokens of a group are linked.

Texts whose white space is plain are cut at words first, where no token reaches across; each different
word of a task is aligned once. All others are aligned as a whole.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardline.llm.chunks import kept, load_vocabulary, tokenizer_path
from wardline.llm.tasks import map_columns, most_frequent, read, stored

#: Aligned words that a Python worker keeps before it starts afresh (some 350 bytes each).
CACHED = 250_000
#: Links of a group up to which they are formed one by one.
LARGE = 256
#: Characters of new words that are aligned in one go; the tokenizers are slower on longer texts.
AT_ONCE = 8_000
#: The most frequent pairs of ids, whose counts are broadcast; counts of all others come by a join.
FREQUENT = 1 << 17

_SPACE = "▁"


def plain(text: str) -> bool:
    """Whether all white space is one blank or one line end between two words, and nothing stands for a blank."""
    parts = text.split()
    gaps = len(parts) - 1
    known = len(text) == sum(map(len, parts)) + gaps and text.count(" ") + text.count("\n") == gaps
    return gaps >= 0 and known and _SPACE not in text


def words_of(text: str) -> list[str]:
    """A plain text, after the blank put before it, in words with the blank or the line end before them."""
    out: list[str] = []
    for k, line in enumerate(text.split("\n")):
        first, *rest = line.split(" ")
        out.append(("\n" if k else " ") + first)
        out += [" " + w for w in rest]
    return out


class Ends:
    """Tokens of both tokenizers for a text, each as ids and the byte offsets where they end."""

    def __init__(self, file_a: str, tokens_a: list[bytes], model_b: bytes):
        self.a = Tokenizer.from_str(file_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = tokens_a
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in ts], np.int64) for ts in (self.bytes_a, self.bytes_b))
        #: Whether pieces of B keep to words, so that plain texts may be cut there.
        self.by_word = not any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces)

    @staticmethod
    def _refined(coarse: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Ends of tokens: coarse ones where they agree with the length of the token, decoded bytes between those.

        `coarse` may repeat or skip; a token keeps it if the token before ends where this one must begin.
        """
        exact = np.diff(coarse, prepend=0) == size
        if exact.all():
            return coarse
        # Tokens in runs that do not agree are laid one behind the other from the end of the last one that does.
        ends, total = coarse.copy(), np.cumsum(size)
        last = np.maximum.accumulate(np.where(exact, np.arange(len(size)), -1))
        inner = ~exact
        base = np.where(last >= 0, coarse[last] - total[last], 0)
        ends[inner] = total[inner] + base[inner]
        return ends

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """`ids, ends` of A and of B for a blank and `text`; None if the bytes of either's tokens differ from it."""
        raw = (" " + text).encode("utf-8", "surrogatepass")
        found = self.a.encode(" " + text, add_special_tokens=False)
        a = np.array(found.ids, np.int64)
        ends = np.array([e for _, e in found.offsets], np.int64)
        if len(raw) != len(text) + 1:  # characters to bytes
            points = np.frombuffer(raw, np.uint8)
            ends = np.append(np.flatnonzero((points & 0xC0) != 0x80), len(raw))[ends]
        pieces = self.b.encode(text, return_type="proto", num_threads=1).pieces
        b, ends_b = np.array([x for p in pieces for x in (p.id, p.end)], np.int64).reshape(-1, 2).T
        ends_b = ends_b + 1
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != raw or b"".join([self.bytes_b[i] for i in b.tolist()]) != raw:
            return None
        return a, self._refined(ends, self.size_a[a]), b, self._refined(ends_b, self.size_b[b])


class Cuts:
    """Texts laid one behind the other, with tokens that keep to them, cut into groups.

    Per text: numbers of tokens, groups and links, the groups written out, and the linked pairs of ids
    (as a << 32 | b) with how many occurrences are linked. Pairs may repeat in a text.
    """

    def __init__(self, bounds: np.ndarray, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray):
        ends, to_a, to_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        to_a, to_b = to_a + 1, to_b + 1
        from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        size_a, size_b, of = to_a - from_a, to_b - from_b, np.searchsorted(bounds, ends)
        n = len(bounds)
        self.numbers = np.stack([np.bincount(of, w, n).astype(np.int64) for w in (size_a, size_b, np.ones(len(of)), size_a * size_b)], axis=1)
        self.shown = self._written(a, b, to_a, to_b, size_a, size_b, of)
        large = size_a * size_b > LARGE
        small = np.where(large, 0, size_a * size_b)
        group = np.repeat(np.arange(len(of)), small)
        k = np.arange(len(group)) - np.repeat(np.cumsum(small) - small, small)
        pairs = a[from_a[group] + k // size_b[group]] << 32 | b[from_b[group] + k % size_b[group]]
        times, text = np.ones(len(pairs), np.int64), of[group]
        for g in np.flatnonzero(large).tolist():  # by different ids: a long group may hold few of them
            (i, n_i), (j, n_j) = (np.unique(x, return_counts=True) for x in (a[from_a[g] : to_a[g]], b[from_b[g] : to_b[g]]))
            pairs, times = np.append(pairs, (i[:, None] << 32 | j).ravel()), np.append(times, (n_i[:, None] * n_j).ravel())
            text = np.append(text, np.full(len(i) * len(j), of[g]))
        order = np.argsort(text, kind="stable")
        self.pairs, self.times, self.n_pairs = pairs[order], times[order], np.bincount(text, minlength=n)

    @staticmethod
    def _written(a, b, to_a, to_b, size_a, size_b, of) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text: every token with the sign behind it, in order of groups."""
        before_a, before_b = np.repeat(to_b - size_b, size_a), np.repeat(to_a, size_b)
        out = np.empty(len(a) + len(b), np.int64)
        after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after_a[to_a - 1] = 1
        after_b[to_b - 1] = np.where(np.diff(of, append=-1) != 0, 3, 2)
        out[np.arange(len(a)) + before_a], out[np.arange(len(b)) + before_b] = a * 4 + after_a, b * 4 + after_b
        return "".join(map(_signed, out.tolist())).split("\n")[:-1]


class _Signs(dict):
    """`id * 4 + sign` to text."""

    def __missing__(self, code: int) -> str:
        self[code] = text = f"{code >> 2}{',|;'[code & 3] if code & 3 < 3 else chr(10)}"
        return text


_signed = _Signs().__getitem__


class Aligner:
    """Aligns texts. Different words of plain texts are aligned once, as long as they fit in a bound of words."""

    def __init__(self, ends: Ends):
        self.ends = ends
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.shown: list[str] = []
        self.numbers, self.first = np.zeros((1024, 4), np.int64), np.zeros(1025, np.int64)
        self.pairs, self.times = np.zeros(1024, np.int64), np.zeros(1024, np.int64)

    @staticmethod
    def _with(held: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
        if at + len(more) > len(held):
            held = np.resize(held, (2 * (at + len(more)), *held.shape[1:]))
        held[at : at + len(more)] = more
        return held

    def _learn(self, words: list[str]) -> None:
        """Aligns words that are not known, laid one behind the other: no token reaches across them. A word without tokens is -1."""
        found = self.ends.of("x" + "".join(words))
        if found is None:
            if len(words) == 1:
                self.known[words[0]] = -1
            else:
                for half in (words[: len(words) // 2], words[len(words) // 2 :]):
                    self._learn(half)
            return
        bounds = np.cumsum([2, *(len(w.encode("utf-8", "surrogatepass")) for w in words)])
        cuts = Cuts(bounds, *found)
        n, at = len(self.shown), int(self.first[len(self.shown)])
        skip = int(cuts.n_pairs[0])  # the first is the x
        self.numbers, self.first = self._with(self.numbers, n, cuts.numbers[1:]), self._with(self.first, n + 1, at + np.cumsum(cuts.n_pairs[1:]))
        self.pairs, self.times = self._with(self.pairs, at, cuts.pairs[skip:]), self._with(self.times, at, cuts.times[skip:])
        self.shown += cuts.shown[1:]
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def _of_words(self, words: list[str]):
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if (at < 0).any():
            return None
        first, n = self.first[at], self.first[at + 1] - self.first[at]
        pick = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        return self.numbers[at].sum(axis=0), ";".join([self.shown[k] for k in at.tolist()]), self.pairs[pick], self.times[pick]

    def block(self, texts: list[str]) -> Iterator[tuple | None]:
        """For each text its numbers of tokens, groups and links, its groups written out, its pairs and their times; None without tokens."""
        cut = [words_of(t) if self.ends.by_word and plain(t) else None for t in texts]
        if len(self.known) > CACHED:
            self._empty()
        new, size = [], 0
        for w in {w for ws in cut if ws for w in ws}.difference(self.known):
            new.append(w)
            size += len(w)
            if size > AT_ONCE:
                self._learn(new)
                new, size = [], 0
        if new:
            self._learn(new)
        for text, ws in zip(texts, cut, strict=True):
            if ws:
                yield self._of_words(ws)
                continue
            found = self.ends.of(text) if text else None
            if found is None:
                yield None
                continue
            cuts = Cuts(np.array([found[1][-1]]), *found)
            yield cuts.numbers[0], cuts.shown[0], cuts.pairs, cuts.times


def align(docs: DataFrame, file_a: str, model_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`<key>, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times` of each document.

    `pairs` are the different linked pairs of ids as `a << 32 | b`, `times` how often each is linked.
    Special tokens in a text are plain text. Null and empty texts, and texts whose tokens' bytes differ
    from a blank and the text, have no tokens: zeros, empty arrays, an empty string for the hash. A
    text of any length is aligned whole; a group's pairs are formed from its different ids. Equal texts
    have equal results, and repeated rows stay.
    """
    with open(model_b, "rb") as f:
        model = f.read()
    vocabulary = load_vocabulary(file_a)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.text, vocabulary.tokens, model))
    name = hashlib.sha256(vocabulary.text.encode() + model).hexdigest()

    def start():
        # Words that a task has aligned serve the next task of its worker.
        aligner = kept(f"aligner {name}", lambda: Aligner(Ends(*shared.value)))

        def step(columns):
            ids, texts = columns
            out = []
            for id_, found in zip(ids, aligner.block([t or "" for t in texts]), strict=True):
                if found is None:
                    out.append((id_, 0, 0, 0, 0, "", [], []))
                    continue
                numbers, shown, pairs, times = found
                different, where = np.unique(pairs, return_inverse=True)
                n = np.bincount(where, times, len(different)).astype(np.int64)
                out.append((id_, *numbers.tolist(), hashlib.sha256(shown.encode()).hexdigest(), different, n))
            return list(zip(*out, strict=True))

        return step

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    found = map_columns(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), schema, start)
    return found.withColumnRenamed("id", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """`pair, count, best`: how many documents hold a pair, and whether no pair of its A id is held by more."""
    counted = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").count(), "pairs")
    a = F.shiftright("pair", 32).alias("a")
    highest = counted.groupBy(a).agg(F.max("count").alias("highest"))
    return counted.select("pair", "count", a).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def count_links(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """`aligned` (a written table with a column `row` that tells rows apart) with `n_best` and `count_sum`.

    Counts of the most frequent pairs are broadcast, a bounded number of rows; what is left are pairs
    of which none is hot, and those meet their counts in a join.
    """
    counts = stored(pair_counts(aligned), "counts")
    top = most_frequent(counts, frequent, "count")
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("n"))
    looked_up = links.join(F.broadcast(top), "pair", "left")
    others = links.join(F.broadcast(top.select("pair")), "pair", "left_anti").join(counts.join(top.select("pair"), "pair", "left_anti"), "pair")
    best, total = F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)), F.sum(F.col("n") * F.col("count"))
    sums = looked_up.where("count IS NOT NULL").unionByName(others).groupBy("row").agg(best.alias("n_best"), total.alias("count_sum"))
    found = aligned.drop("pairs", "times").join(sums, "row", "left")
    return found.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")})


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    aligned = stored(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    return count_links(aligned).drop("row")
