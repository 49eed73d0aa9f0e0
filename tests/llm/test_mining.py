"""Hard negatives, token alignment and mixing against plain Python."""

import bisect
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.data import CLASHING, documents, odd_texts, prose
from wardline.llm import hard_negatives, mixing, token_alignment
from wardline.llm.chunks import load_vocabulary, tokenizer_path

# Hard negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_mine(rows):
    """Scores of every anchor with every row, sorted."""
    sound = [(k, i, [math.floor(256 * float(np.float32(x))) for x in v], y) for k, (i, v, y) in enumerate(rows) if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, anchor, v, y in sound:
        if anchor is None or anchor % 100:
            continue
        scored = sorted([(-sum(a * b for a, b in zip(v, w, strict=False)), math.inf if i is None else i, i, z == y) for m, i, w, z in sound if m != k], key=lambda r: r[:2])
        for p, _, positive, _ in [s for s in scored if s[3]][:5]:
            inside = [(-n, i) for n, _, i, same in scored if not same and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(anchor, positive, rank, i, -p, n) for rank, (n, i) in enumerate(inside, 1)]
    return sorted(out, key=repr)


def unit(r, n=24, near=None):
    v = [r.gauss(0, 1) for _ in range(n)] if near is None else [x + r.gauss(0, 0.1) for x in near]
    size = math.sqrt(sum(x * x for x in v))
    return [x / size for x in v]


def mined(spark, rows, more=False, **settings):
    df = spark.createDataFrame(rows, VECTORS)
    df = df.selectExpr("*", *[f"'?' AS `{c}`" for c in CLASHING]) if more else df
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **settings).collect()), key=repr)


@pytest.mark.parametrize("dims", [1, 5, 24])
def test_mining_equals_all_scores(spark, dims):
    r = random.Random(dims)
    heads = [unit(r, dims) for _ in range(4)]
    rows = [(k * 10, unit(r, dims, heads[k % 4] if k % 3 else None), k % 5) for k in range(90)]
    wanted = plain_mine(rows)
    assert wanted and mined(spark, rows) == wanted
    # Rounds of few anchors, blocks of few rows and levels that are always computed in full give the same.
    assert mined(spark, rows, round_bytes=16 * dims * 2) == wanted


def test_mining_on_odd_rows(spark, monkeypatch):
    r = random.Random(3)
    v = unit(r)
    rows = [(k, v, k % 2) for k in range(0, 400, 25)]  # equal vectors: all scores tie
    rows += [(None, v, 0), (7, None, 0), (8, v, None), (9, [*v[:3], None], 1), (11, [math.nan] * 24, 1), (13, [math.inf, *v[1:]], 0), (15, [], 0), (17, v[:5], 1), (500, [-x for x in v], 3)]
    wanted = plain_mine(rows)
    assert wanted and mined(spark, rows, more=True) == wanted
    monkeypatch.setattr(hard_negatives, "DENSE", 2.0)
    assert mined(spark, rows) == wanted
    assert mined(spark, []) == [] and mined(spark, [(5, v, 0)]) == [] and mined(spark, [(100, v, 0)]) == []
    twice = [(100, v, 0), (100, v, 0), (3, v, 1), (3, v, 1)]
    assert [x[3] for x in mined(spark, twice)] == [3] * 4


def test_bounds_hold_and_rule_out():
    r = np.random.default_rng(5)
    heads = r.normal(size=(8, 64)).repeat(8, axis=1)[:, :64] * 200
    v = np.floor(heads[r.integers(0, 8, 400)] + r.normal(size=(400, 64)) * 5)
    s, exact = hard_negatives.summaries(v).astype(float), v @ v.T
    open_ = []
    for mean, deviation in hard_negatives.level_slices(64):
        middle, spread = s[:, mean] @ s[:, mean].T, s[:, deviation] @ s[:, deviation].T
        slack = 0.5 + 1e-6 * np.sqrt(np.outer(np.diag(exact), np.diag(exact)))
        assert (middle - spread - slack <= exact).all() and (exact <= middle + spread + slack).all()
        open_.append(int((middle + spread >= np.quantile(exact, 0.95)).sum()))
    assert open_[0] > open_[1] > open_[2] and open_[2] < 0.2 * exact.size


# Alignment


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model")), load_vocabulary(tokenizer_path()).tokens


def plain_align(tokenizers, texts):
    """By the decoded bytes of whole texts alone."""
    a, b, bytes_a = tokenizers
    rows, links = [], []
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "", return_type=int)
        raw_a = [bytes_a[i] for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            rows.append([0, 0, 0, 0, ""])
            links.append(Counter())
            continue
        ends = [np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        pairs = [([], []) for _ in shared]
        for side, (ids, end) in enumerate(((ids_a, ends[0]), (ids_b, ends[1]))):
            for i, e in zip(ids, end, strict=True):
                pairs[bisect.bisect_left(shared, e)][side].append(i)
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in pairs)
        links.append(Counter((i, j) for x, y in pairs for i in x for j in y))
        rows.append([len(ids_a), len(ids_b), len(pairs), links[-1].total(), hashlib.sha256(shown.encode()).hexdigest()])
    count = Counter(p for held in links for p in held)
    highest = defaultdict(int)
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    return [(*r, sum(n for p, n in held.items() if count[p] == highest[p[0]]), sum(n * count[p] for p, n in held.items())) for r, held in zip(rows, links, strict=True)]


ODD = ["a  b", " a", "a ", "a\nb", "a\n\nb", "\n", "▁a b", "a▁b c", "é\U0001f642 x", "中文字 ｆｕｌｌ a", "a\x00b c", "\r\n x", "ß\nÀÉ x́ \U0001f469‍\U0001f467 k", "a" * 300, "\U0001f642" * 60, "<s> </s> <unk> <|endoftext|>", "don't 12ab3 x.,!y"]


@pytest.mark.parametrize("frequent", [0, 50, token_alignment.FREQUENT])
def test_alignment_equals_decoded_bytes(spark, tokenizers, frequent):
    texts = [*ODD, *[t for _, t in (r[:2] for r in odd_texts())], *[prose(k, 40) for k in range(20)], *["the same text, twice"] * 2]
    docs = documents(spark, list(enumerate(texts)), more=True)
    found = token_alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model")).withColumn("row", F.monotonically_increasing_id())
    got = token_alignment.count_links(token_alignment.stored(found, "aligned"), frequent)
    columns = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    rows = {r.doc_id: tuple(r[c] for c in columns) for r in got.collect()}
    for k, wanted in enumerate(plain_align(tokenizers, texts)):
        assert rows[k] == wanted, texts[k]


def test_long_groups_and_full_caches(tokenizers, monkeypatch):
    a, b, bytes_a = tokenizers
    ends = token_alignment.Ends(a.to_str(), bytes_a, b.serialized_model_proto())
    texts = [*ODD, *[prose(k, 60) for k in range(30)]]
    whole = [x and (x[0].tolist(), x[1], Counter(dict(_summed(x)))) for x in token_alignment.Aligner(ends).block(texts)]
    for name, value in (("LARGE", 0), ("CACHED", 5), ("AT_ONCE", 10)):
        monkeypatch.setattr(token_alignment, name, value)
    aligner = token_alignment.Aligner(ends)
    assert [x and (x[0].tolist(), x[1], Counter(dict(_summed(x)))) for t in texts for x in aligner.block([t])] == whole


def _summed(x):
    n = Counter()
    for pair, times in zip(x[2].tolist(), x[3].tolist(), strict=True):
        n[pair] += times
    return n


# Mixing


def xx(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(8 if v.__class__ is Long else 4, "little", signed=True), h)
    return h - (1 << 64) if h >> 63 else h


class Long(int):
    pass


def plain_targets(sizes, weights, share, most):
    """Shares by weight; what is above a limit is shared again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target, left, open_ = {s: weights[k % len(weights)] for k, s in enumerate(order)}, {}, share * sum(sizes.values()) / 100, list(order)
    while True:
        given = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if given[s] >= most * sizes[s]]
        if not above:
            return {**target, **given}
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.remove(s)
        if not open_:
            return target


def swapped(x, n, *of):
    for turn in range(1, mixing.ROUNDS + 1):
        mirror = ((xx(*of, turn) % n) - x) % n
        x = mirror if xx(*of, turn, Long(max(x, mirror))) & 1 else x
    return x


def plain_taken(rows, target, size, place, block, seed):
    """Words of one source that the mix takes, word by word. `rows`: (key, size)."""
    stream = [key for key, n in sorted(rows, key=lambda r: _bucket(r[0], seed)) for _ in range(n)]
    blocks = [stream[at : at + block] for at in range(0, len(stream), block)]
    wanted, taken, turn = math.floor(target + 0.5), Counter(), 0
    while wanted > 0:
        order = sorted(range(len(blocks)), key=lambda b: swapped(b, len(blocks), seed, Long(place), Long(turn)))
        for b in order:
            taken.update(blocks[b][:wanted])
            wanted -= min(wanted, len(blocks[b]))
        turn += 1
    return taken


def _bucket(key, seed, buckets=[1]):
    h = xx(seed, str(key))
    return h % buckets[0], h, key


def test_mix_takes_what_plain_python_takes(spark, monkeypatch):
    r = random.Random(8)
    rows = [(k, prose(k, r.randrange(0, 90)) if k % 9 else None, "en", [None, "b", "a", "c", "é"][r.randrange(25) // 5 if k % 3 else 1]) for k in range(150)]
    docs = spark.createDataFrame([(i, t, la, s, 0) for i, t, la, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", *[f"'?' AS `{c}`" for c in CLASHING])
    monkeypatch.setattr(mixing, "ROWS_A_BUCKET", 40)
    buckets = -(-len(rows) // 40)
    got = {x.doc_id: x for x in mixing.mix(docs, block=32, shards=5).collect()}
    size = {i: len((t or "").split()) for i, t, _, _ in rows}
    of = Counter()
    for i, _, _, s in rows:
        of[s] += size[i]
    target = plain_targets(of, mixing.WEIGHTS, mixing.SHARE, mixing.MOST)
    places = {s: k for k, s in enumerate(sorted(of, key=lambda s: (s is None, s or "")), 1)}
    monkeypatch.setattr("tests.llm.test_mining._bucket.__defaults__", ([buckets],))
    for s in of:
        taken = plain_taken([(i, size[i]) for i, _, _, x in rows if x == s], target[s], of[s], places[s], 32, mixing.SEED)
        for i in (i for i, _, _, x in rows if x == s):
            assert got[i].size == size[i] and got[i].source_size == of[s] and got[i].target == pytest.approx(target[s])
            assert sum(d.words for d in got[i].draws) == taken[i] <= 2 * size[i]
    # No word is taken twice in a pass, and shards hold nearly the same number of blocks.
    spans, blocks = Counter(), set()
    for i, x in got.items():
        for d in x.draws:
            blocks.add((d.shard, d.at))
            for w in range(d.begin, d.begin + d.words):
                spans[i, d["pass"], w] += 1
    assert set(spans.values()) == {1}
    by_shard = Counter(shard for shard, _ in blocks)
    assert sorted(by_shard) == list(range(5)) and max(by_shard.values()) - min(by_shard.values()) <= 2


def test_mix_is_the_same_on_any_partitions(spark):
    docs = documents(spark, [(k, prose(k, k % 70)) for k in range(120)])
    rows = [sorted((r.doc_id, [tuple(d) for d in r.draws]) for r in mixing.mix(d, block=16).collect()) for d in (docs, docs.repartition(7, "lang"))]
    assert rows[0] == rows[1]


def test_mix_of_many_sources_and_odd_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "STRATA", 7)
    docs = spark.createDataFrame([(k, prose(k, 20 + k % 30), f"s{k % 50}") for k in range(300)], "doc_id long, text string, source string")
    got = mixing.mix(docs, block=8, shards=3).collect()
    taken = defaultdict(int)
    for r in got:
        taken[r.source, r.target] += sum(d.words for d in r.draws)
    assert len(taken) == 50 and all(abs(n - t) <= 0.5 for (_, t), n in taken.items())
    odd = documents(spark, odd_texts(), more=True)
    rows = mixing.mix(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_texts())
    assert sum(d.words for r in rows for d in r.draws) == math.floor(1.5 * sum(r.size for r in rows) + 0.5)
    assert mixing.mix(documents(spark, [])).collect() == []
    wordless = mixing.mix(documents(spark, [(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.draws) for r in wordless] == [(0, 0.0, [])] * 2
    unique = documents(spark, [(k, prose(k, 50 + k)) for k in range(30)])
    mixing.write_mix(unique, str(tmp_path / "mix"), block=16, shards=4)
    written = spark.read.parquet(str(tmp_path / "mix")).collect()
    assert {r.shard for r in written} == {0, 1, 2, 3} and all(len(r.text.split()) == r.words for r in written)
    assert sum(r.words for r in written) == math.floor(1.5 * sum(50 + k for k in range(30)) + 0.5)


def test_hypergeometric_draws(spark):
    uniform = f"shiftrightunsigned(xxhash64(id, 5), 11) * {2.0**-53!r}D"
    for n, c, a in ((50, 20, 13), (10, 10, 4), (7, 3, 7), (40, 1, 20), (1, 1, 1)):
        got = Counter(r[0] for r in spark.range(6000).selectExpr(mixing.hypergeometric(f"{n}L", f"{c}L", f"{a}L", uniform)).collect())
        chance = {x: math.comb(c, x) * math.comb(n - c, a - x) / math.comb(n, a) for x in range(max(0, a + c - n), min(a, c) + 1)}
        assert set(got) <= set(chance)
        chi = sum((got[x] - 6000 * p) ** 2 / (6000 * p) for x, p in chance.items() if 6000 * p > 5)
        assert chi < 40, (n, c, a, chi)
    big = spark.range(400).selectExpr(mixing.hypergeometric("2000000L", "700000L", "1000000L", uniform)).collect()
    assert abs(np.mean([r[0] for r in big]) - 350_000) < 60 and 200 < np.std([r[0] for r in big]) < 500


def test_split_keeps_quotas(spark):
    quotas = [0, 1, 5, 1000, 40, 3]
    df = spark.createDataFrame([(quotas,)], "quotas array<long>")
    for shards in (1, 2, 5, 64):
        rows = sorted(mixing.split_quotas(df, shards).collect())
        assert [r.shard for r in rows] == list(range(shards))
        assert [sum(q) for q in zip(*[r.quotas for r in rows], strict=True)] == quotas
        sizes = [sum(r.quotas) for r in rows]
        assert max(sizes) - min(sizes) <= (shards - 1).bit_length() and all(q >= 0 for r in rows for q in r.quotas)
