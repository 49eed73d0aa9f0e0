"""Token ids in files of static range asymmetric numeral systems (rANS).

A segment is a file of its own: a table of symbol frequencies that all its blocks share, and blocks
that are coded independently, each by many interleaved states. The directory of a segment holds for
each block where its words start, the states to start from (a checkpoint) and a checksum, so blocks
can be decoded in parallel and any block alone. Here all blocks of a segment advance together, as
rows of one array.

A table of segments is written and read by Spark: any store that Spark reaches will do. Its rows
are in order of (bucket, number), and documents lie in it in ascending order of their id.
"""

import hashlib
import json
import os
import struct
import zlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardline.llm.chunks import Cached, byte_letters, kept, load_vocabulary, pre_tokens, tokenizer_path
from wardline.llm.tasks import map_columns, read, stored

MAGIC, HEADER, COUNTS = b"RANS0001", struct.Struct("<8sIIIQQQ"), struct.Struct("<QQQ")
PRECISION = 18
LANES = 256
BLOCK = 1 << 15
#: A segment is closed with the document that brings it to so many ids.
SEGMENT = 1 << 20
END = 2
#: Chunks that go through the model of the library together.
TOGETHER = 100
#: Chunks that a worker keeps, with the bytes of their ids (some 250 bytes each), and ends of chunks.
KNOWN, ENDS = 1600000, 10_000

_P, _W32 = np.uint64(PRECISION), np.uint64(32)
_LOW, _SLOTS, _LEAST = np.uint64(0xFFFFFFFF), np.uint64((1 << PRECISION) - 1), np.uint64(1 << 31)


class DamagedSegment(ValueError):
    """The bytes of a segment are not what was written."""


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different symbols and their shares of 2**PRECISION, each at least 1; ties go to the smaller symbol."""
    symbols, counts = np.unique(ids, return_counts=True)
    if len(symbols) > 1 << PRECISION:
        raise ValueError("more symbols than the precision can tell apart")
    if not len(symbols):
        return symbols.astype(np.uint32), np.zeros(0, np.uint64)
    # Everybody gets one; the rest is shared in proportion, what rounding leaves goes to the largest.
    rest = (1 << PRECISION) - len(symbols)
    share = 1 + (counts.astype(np.int64) * rest) // counts.sum()
    share[np.argmax(counts)] += (1 << PRECISION) - share.sum()
    return symbols.astype(np.uint32), share.astype(np.uint64)


def _numbers(symbols: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The place of each id among the sorted symbols that it is one of; by a table, if that is not much larger than the ids."""
    if not len(ids) or int(symbols[-1]) > 4 * len(ids) + (1 << PRECISION):
        return np.searchsorted(symbols, ids).astype(np.int64)
    table = np.zeros(int(symbols[-1]) + 1, np.int64)
    table[symbols] = np.arange(len(symbols))
    return table[ids]


def _encode_blocks(rows: np.ndarray, freq: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """`rows`: blocks x steps x lanes of symbol numbers. The states after all, and each block's words in decoding order."""
    blocks, steps, lanes = rows.shape
    state, words, owner = np.full((blocks, lanes), _LEAST), [], []
    for t in range(steps - 1, -1, -1):
        f, s = freq[rows[:, t]], start[rows[:, t]]
        full = (state >> np.uint64(63 - PRECISION)) >= f
        words.append((state[full] & _LOW).astype(np.uint32))
        owner.append(np.nonzero(full)[0])
        state = np.where(full, state >> _W32, state)
        q = state // f
        state = (q << _P) + (state - q * f) + s
    words, owner = np.concatenate(words[::-1]), np.concatenate(owner[::-1])
    words = words[np.argsort(owner, kind="stable")]
    return state, np.split(words, np.cumsum(np.bincount(owner, minlength=blocks))[:-1])


def _decode_blocks(state: np.ndarray, words: np.ndarray, begins: np.ndarray, steps: int, symbol: np.ndarray, freq: np.ndarray, start: np.ndarray) -> np.ndarray:
    out = np.empty((state.shape[0], steps, state.shape[1]), np.uint32)
    at = begins.astype(np.int64)[:, None]
    for t in range(steps):
        slot = state & _SLOTS
        k = symbol[slot.astype(np.int64)]
        out[:, t] = k
        state = freq[k] * (state >> _P) + slot - start[k]
        low = state < _LEAST
        place = np.cumsum(low, axis=1)
        state[low] = (state[low] << _W32) | words[np.minimum((at + place - 1)[low], max(len(words) - 1, 0))]
        at = at + place[:, -1:]
    return out


def write_segment(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file of `ids`, which belong to documents of `lengths`. A pure function of both."""
    symbols, freq = frequencies(ids)
    start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64) if len(freq) else freq
    numbers = _numbers(symbols, ids)
    directory, words = [], []
    whole = len(numbers) // BLOCK * BLOCK
    for part, steps in ((numbers[:whole], BLOCK // LANES), (numbers[whole:], -(-(len(numbers) - whole) // LANES))):
        if len(part):
            padded = np.concatenate((part, np.full(-len(part) % (steps * LANES), part[-1])))
            state, streams = _encode_blocks(padded.reshape(-1, steps, LANES), freq, start)
            for k, stream in enumerate(streams):
                own = ids[sum(d[0] for d in directory) :][: min(BLOCK, len(part) - k * BLOCK)]
                directory.append((len(own), len(stream), zlib.crc32(own.astype("<u4").tobytes()), state[k]))
                words.append(stream)
    table = zlib.compress(np.diff(symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    docs = zlib.compress(lengths.astype("<u8").tobytes(), 6)
    fixed = np.array([d[:3] for d in directory], "<u4").tobytes() + b"".join(d[3].astype("<u8").tobytes() for d in directory)
    body = struct.pack("<QQ", len(table), len(docs)) + table + docs + fixed + b"".join(w.astype("<u4").tobytes() for w in words)
    counts = len(ids), len(lengths), len(directory)
    return HEADER.pack(MAGIC, PRECISION, LANES, zlib.crc32(COUNTS.pack(*counts) + body), *counts) + body


class Segment(NamedTuple):
    ids: np.ndarray
    lengths: np.ndarray


def read_segment(raw: bytes, only: int | None = None) -> Segment:
    """What `write_segment` was given; with `only` the ids of that block alone. Every checksum is tested."""
    if len(raw) < HEADER.size:
        raise DamagedSegment("too short")
    magic, precision, lanes, check, n_ids, n_docs, n_blocks = HEADER.unpack_from(raw)
    body = raw[HEADER.size :]
    if magic != MAGIC or precision != PRECISION or lanes != LANES or zlib.crc32(COUNTS.pack(n_ids, n_docs, n_blocks) + body) != check:
        raise DamagedSegment("wrong header or checksum")
    n_table, n_lengths = struct.unpack_from("<QQ", body)
    at = 16
    table = np.frombuffer(zlib.decompress(body[at : at + n_table]), "<u4")
    at += n_table
    lengths = np.frombuffer(zlib.decompress(body[at : at + n_lengths]), "<u8").astype(np.int64)
    at += n_lengths
    symbols, freq = np.cumsum(table[: len(table) // 2]).astype(np.uint32), table[len(table) // 2 :].astype(np.uint64)
    fixed = np.frombuffer(body, "<u4", 3 * n_blocks, at).reshape(-1, 3).astype(np.int64)
    at += 12 * n_blocks
    states = np.frombuffer(body, "<u8", LANES * n_blocks, at).reshape(-1, LANES).astype(np.uint64)
    at += 8 * LANES * n_blocks
    words = np.frombuffer(body, "<u4", -1, at).astype(np.uint64)
    if len(lengths) != n_docs or len(words) != fixed[:, 1].sum() or fixed[:, 0].sum() != n_ids:
        raise DamagedSegment("lengths differ")
    start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64) if len(freq) else freq
    symbol = np.repeat(np.arange(len(freq)), freq.astype(np.int64))
    begins = np.cumsum(fixed[:, 1]) - fixed[:, 1]
    chosen, out = np.arange(n_blocks) if only is None else np.array([only]), []
    for group in (chosen[fixed[chosen, 0] == BLOCK], chosen[fixed[chosen, 0] < BLOCK]):
        if len(group):
            steps = -(-int(fixed[group[0], 0]) // LANES)
            numbers = _decode_blocks(states[group], words, begins[group], steps, symbol, freq, start)
            for k, flat in zip(group, numbers.reshape(len(group), -1), strict=True):
                own = symbols[flat[: fixed[k, 0]]]
                if zlib.crc32(own.astype("<u4").tobytes()) != fixed[k, 2]:
                    raise DamagedSegment(f"block {k} has a wrong checksum")
                out.append(own)
    return Segment(np.concatenate(out) if out else np.zeros(0, np.uint32), lengths)


def library_encoder(source: str, added: dict[str, int]) -> Cached:
    """Chunks by the tokenizers library, as the bytes of their ids: those that a worker has not met go through its model.

    Many go at a time, with a byte between pre-tokens and another between chunks that no UTF-8 has.
    No merge reaches across a byte that is in no merge; if a tokenizer has one, its pre-tokens go one by one.
    A new chunk that is a known word and punctuation is put together from both.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has a core
    from tokenizers import Tokenizer

    file, letters = json.loads(source)["model"], {b: ord(c) for c, b in byte_letters().items()}
    ends = [chr(letters[b]) for b in (0xFF, 0xFE)]
    apart = all(e in file["vocab"] for e in ends) and not any(e in part for pair in file["merges"] for part in pair for e in ends)
    model = Tokenizer.from_str(source).model
    # The model alone: the text is cut already.
    whole, (chunk_end, token_end) = Tokenizer(model), (file["vocab"].get(e) for e in ends)

    def lettered(text: str) -> str:
        return text.encode("utf-8", "surrogateescape").decode("latin-1").translate(letters)

    def one_by_one(cut: list[list[str]]) -> list[bytes]:
        known = {t: [x.id for x in model.tokenize(lettered(t))] for t in {t for ts in cut for t in ts}}
        return [np.array([i for t in ts for i in known[t]], "<u4").tobytes() for ts in cut]

    ends_known: dict[str, bytes] = {}

    def end_of(token: str) -> bytes:
        if len(ends_known) > ENDS:
            ends_known.clear()
        ends_known[token] = ids = one_by_one([[token]])[0]
        return ids

    def encode_new(new: list[str]) -> list[bytes]:
        cut = list(map(pre_tokens, new))
        if not apart:
            return one_by_one(cut)
        # A word that is known without the punctuation behind it need not go again.
        known, older, out, left, places, words = cached.known, cached.older, [], [], [], []
        for k, ts in enumerate(cut):
            end = b""
            if len(ts) == 2:
                end = ends_known.get(ts[1]) or end_of(ts[1])
                if ids := known.get(ts[0]) or older.get(ts[0]):
                    out.append(ids + end)
                    continue
                words.append(k)
                ts = ts[:1]
            left.append(ts)
            places.append(k)
            out.append(end)
        for k, ids in zip(places, together(left), strict=True):
            out[k] = ids + out[k]
        # Words that were met with punctuation only are kept alone as well.
        known.update((cut[k][0], out[k][: -len(ends_known.get(cut[k][1]) or end_of(cut[k][1]))]) for k in words)
        return out

    def together(cut: list[list[str]]) -> list[bytes]:
        out = []
        for at in range(0, len(cut), TOGETHER):
            # Escaped, these two become the bytes 0xFE and 0xFF.
            text = "\udcff".join(["\udcfe".join(ts) for ts in cut[at : at + TOGETHER]])
            ids = np.array(whole.encode_batch_fast([lettered(text)], add_special_tokens=False)[0].ids, "<u4")
            ids = ids[ids != token_end]
            raw, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == chunk_end)).tolist()
            out += [raw[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], [*cuts, len(raw)], strict=True)]
        return out

    cached = Cached(encode_new, added, lambda k: np.array([k], "<u4").tobytes(), KNOWN)
    return cached


def token_segments(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` as segments: `bucket, number, before, n_tokens, keys, segment`.

    Texts are encoded with the tokenizers library without special tokens, null as empty, and END is
    appended to each. Documents are dealt to buckets by ranges of their key and sorted in each, nulls
    first, equal keys by their text; rows are neither dropped nor merged. `before` counts the ids of
    the bucket's earlier segments. A task holds one segment at a time.
    """
    vocabulary = load_vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.text, vocabulary.added))

    def start():
        from pyspark import TaskContext

        source, added = shared.value
        bucket = TaskContext.get().partitionId()
        cached = kept(hashlib.sha256(source.encode()).hexdigest(), lambda: library_encoder(source, added))
        end = np.array([END], "<u4").tobytes()
        keys, arrays, seen = [], [], {"number": 0, "before": 0, "held": 0}

        def closed():
            ids, lengths = np.concatenate(arrays), np.array([len(a) for a in arrays], np.int64)
            row = (bucket, seen["number"], seen["before"], len(ids), list(keys), write_segment(ids, lengths))
            seen.update(number=seen["number"] + 1, before=seen["before"] + len(ids), held=0)
            keys.clear()
            arrays.clear()
            return row

        def step(columns):
            if columns is None:
                return [[x] for x in closed()] if keys else None
            rows = []
            for k, parts in zip(columns[0], cached.encode([t or "" for t in columns[1]]), strict=True):
                keys.append(k)
                parts.append(end)
                arrays.append(np.frombuffer(b"".join(parts), "<u4"))
                seen["held"] += len(arrays[-1])
                if seen["held"] >= SEGMENT:
                    rows.append(closed())
            return list(zip(*rows, strict=True)) if rows else None

        return step

    kind = docs.schema[key].dataType.simpleString()
    dealt = docs.select(F.col(key), F.col(text)).repartitionByRange(F.col(key)).sortWithinPartitions(key, text)
    return map_columns(dealt, f"bucket int, number int, before long, n_tokens long, keys array<{kind}>, segment binary", start, finish=True)


def read_token_segments(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document of written segments: key, `start`, `n_tokens`, `ids_crc32`, all from the segments' bytes."""

    def start():
        def step(columns):
            rows = []
            for _, first, keys, raw in zip(*columns, strict=True):
                ids, lengths = read_segment(raw)
                ends = np.cumsum(lengths)
                for k, begin, end in zip(keys, (ends - lengths).tolist(), ends.tolist(), strict=True):
                    rows.append((k, first + begin, end - begin, zlib.crc32(ids[begin:end].astype("<u4").tobytes())))
            return list(zip(*rows, strict=True)) if rows else None

        return step

    # A row for each bucket, as many as the write had partitions.
    buckets = segments.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))
    order = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.select("bucket", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    placed = segments.join(F.broadcast(buckets), "bucket").select("bucket", (F.col("first") + F.col("before")).alias("first"), "keys", "segment")
    kind = segments.schema["keys"].dataType.elementType.simpleString()
    return map_columns(placed, f"{key} {kind}, start long, n_tokens long, ids_crc32 long", start)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return read_token_segments(stored(token_segments(docs, tokenizer_path()), "token-files"))
