"""Joins, lookups and files against brute force."""

import hashlib
import itertools
import json
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.data import documents, odd_texts, prose
from wardline.llm import bpe, decontamination, jaccard_join, sharding, token_files, url_filters
from wardline.llm.chunks import PATTERN, byte_letters, chunks, load_vocabulary, tokenizer_path


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    lead = list(range(len(rows)))

    def find(k):
        while lead[k] != k:
            k = lead[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                lead[find(i)] = find(j)
    least = {}
    for k, (id_, _) in enumerate(rows):
        least.setdefault(find(k), []).append(id_)
    return {id_: (len(sets[k]), min(least[find(k)])) for k, (id_, _) in enumerate(rows)}


def near_copies(seed, groups=40, most=12):
    """Groups of edited copies of all sizes, many with a similarity about the threshold, and passages that all share."""
    r, rows = random.Random(seed), []
    shared = prose(seed, 30).split()
    for g in range(groups):
        words = prose(1000 * seed + g, r.choice([3, 5, 6, 8, 12, 20, 40, 90, 200])).split()
        if r.random() < 0.4:
            words = shared + words
        for _ in range(r.randrange(1, most)):
            copy = list(words)
            for _ in range(r.randrange(0, 1 + max(1, len(copy) // 25))):
                copy[r.randrange(len(copy))] = f"edit{r.random()}"
            if r.random() < 0.3:
                copy = copy[: max(1, len(copy) - r.randrange(1 + len(copy) // 5))]
            rows.append((len(rows), " ".join(copy)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "long"), [(1, 1.0), (2, 0.0)])
def test_components(spark, monkeypatch, seed, long):
    """With a small bound all lists that are mixed are split by further keys."""
    monkeypatch.setattr(jaccard_join, "LONG", long)
    rows = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_components_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard_join, "BROADCAST_KEYS", 0)
    rows = near_copies(3, groups=15, most=6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_keys_of_similar_sets_meet():
    """Whatever differs within the threshold, both sets have a block key in common; so have their light items two."""
    r = np.random.default_rng(5)
    for n in [2, 3, 4, 5, 7, 9, 10, 16, 20, 33, 50, 64, 100, 255, 256, 300]:
        for _ in range(30):
            a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            drop = r.integers(0, n // 5 + 1)
            room = int((len(a) - drop) / 0.8) - len(a)
            b = np.unique(np.concatenate((r.permutation(a)[drop:], r.integers(0, 1 << 63, max(0, int(r.integers(0, room + 1))), dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            keys = [{k for lst in jaccard_join.block_lists(s) for k in lst[: len(s) // 4 + 1]} for s in (a, b)]
            assert keys[0] & keys[1]
            firsts = [set(jaccard_join.light_items(s)[: len(s) - jaccard_join.least_overlap(len(s)) + 2]) for s in (a, b)]
            assert len(firsts[0] & firsts[1]) >= min(2, both)


@pytest.mark.parametrize("n", [4, 5, 6])
def test_tiny_sets_in_long_lists(spark, monkeypatch, n):
    """Sets of n and n + 1 shingles link by one base each, though all lists are split and blocks are preferred."""
    monkeypatch.setattr(jaccard_join, "LONG", 0.0)
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda classes: 1)
    base = prose(40 + n, n + 4)
    rows = [(k, f"{base} edit{k}") for k in range(1, 31)] + [(40, base)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == brute_components(rows) and {c for _, c in got.values()} == {1}


def test_enough_common_blocks_to_split():
    """Two similar sets above TINY have a level whose equal blocks, or else shingles, last for all splits."""
    for a in range(1, 300):
        for b in range(a, 5 * a // 4 + 1):
            apart = (a + b) // 9
            apart -= (a + b - apart) % 2  # the difference is even or odd as the sum is
            if apart < b - a or apart == 0:
                continue
            if b <= jaccard_join.TINY:
                assert (a + b - apart) // 2 >= 2 + jaccard_join.SPLITS
                continue
            levels = [{n.bit_length() - 1, (5 * n // 4).bit_length() - 1} for n in (a, b)]
            assert max(3 * (1 << level) // 4 - apart for level in levels[0] & levels[1]) >= 1 + jaccard_join.SPLITS


def test_parities_never_refuse_a_link():
    r = np.random.default_rng(6)
    for n in (5, 30, 31, 32, 33, 400):
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[n // 10 :], r.integers(0, 1 << 63, n // 20, dtype=np.uint64))))

        def parity(s):
            places = 1 << max(6, (4 * len(s)).bit_length())
            return np.packbits(np.bincount((s >> np.uint64(9)).astype(np.int64) & (places - 1), minlength=places).astype(np.uint8) & 1).tobytes()

        if jaccard_join.links_of(a.tobytes(), b.tobytes()):
            assert jaccard_join.may_link(len(a), parity(a), len(b), parity(b))


def test_pairs_of_a_tile():
    """As many pairs as `may_link` allows one by one, between sides and within one."""
    r = np.random.default_rng(7)
    base, rows = np.unique(r.integers(0, 1 << 63, 140, dtype=np.uint64)), []
    for k in range(60):
        kept = r.permutation(base)[: r.integers(25, 141)]
        s = np.unique(np.concatenate((kept, r.integers(0, 1 << 63, r.integers(0, 9), dtype=np.uint64))))
        places = 1 << max(6, (2 * len(s)).bit_length())
        odd = np.bincount((s >> np.uint64(9)).astype(np.int64) & (places - 1), minlength=places).astype(np.uint8) & 1
        rows.append((k % 3 == 0, k, len(s), k % 7, np.packbits(odd).tobytes()))
    for tile in (rows, [(True, *x[1:]) for x in rows], rows[:1]):
        want = {(x[1], y[1]) for x in tile for y in tile if x[1] < y[1] and x[3] != y[3] and jaccard_join.may_link(x[2], x[4], y[2], y[4])}
        want = {(a, b) for a, b in want if len({t[0] for t in tile}) == 1 or tile[a][0] != tile[b][0]}
        got = jaccard_join.near_pairs(tile)
        assert set(got) == want and len(got) == len(want) and (len(want) > 5 or len(tile) == 1)
        few = jaccard_join.near_pairs(tile, forest=True)
        of = {x[1]: x[3] for x in tile}

        def joined(pairs):
            names = {c: c for c in of.values()}
            for a, b in pairs:
                old, new = names[of[a]], names[of[b]]
                names = {c: new if x == old else x for c, x in names.items()}
            return {frozenset(c for c in names if names[c] == x) for x in names.values()}

        assert set(few) <= want and joined(few) == joined(want) and len(few) < max(2, len(tile))


def test_related_texts_make_no_more_rows_than_keys(spark, monkeypatch):
    """Texts that share most blocks, but too few for a link, fill many long lists with the same classes."""
    shared, rows = prose(77, 84).split(), []
    for k in range(60):
        words = list(shared)
        for at in range(k % 4, 84, 14):
            words[at] = f"own{k}x{at}"
        rows.append((k, " ".join(words)))
    sizes, stored = [], jaccard_join.stored

    def counted(df, purpose):
        out = stored(df, purpose)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == brute_components(rows)
    keys = sum(len(b) for _, x in rows for b in jaccard_join.block_lists(jaccard_join.shingle_set(x, jaccard_join._Hashes())))
    assert max(sizes) <= keys


def test_lookup_table():
    shards = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(shards, 503)
    sizes = [table.count(s) for s in shards]
    assert sum(sizes) == 503 and max(sizes) - min(sizes) <= 1
    # Plain form: in turns, each shard takes its next preferred free slot.
    slots, at = [None] * 503, dict.fromkeys(shards, 0)
    while None in slots:
        for s in shards:
            if None in slots:
                start, stride = sharding._preference(s, 503)
                while slots[(start + at[s] * stride) % 503] is not None:
                    at[s] += 1
                slots[(start + at[s] * stride) % 503] = s
    assert table == slots
    fewer = sharding.lookup_table(shards[:-1], 503)
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a != "s6") < 0.25 * 503
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(wrong, 503)
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 500)


def test_placement_and_written_shards(spark, tmp_path):
    docs = documents(spark, [(k, "x") for k in range(500)] + [(None, "y"), (7, "z")])
    placed = sharding.place(docs, "doc_id", ["a", "b", "c"], 101).collect()
    assert len(placed) == 502 and len({r.shard for r in placed if r.doc_id == 7}) == 1
    sharding.write_shards(sharding.place(docs, "doc_id", ["a", "b", "c"], 101), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 3


def plain_segments(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    at, out = 0, []
    for k, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((k, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, tmp_path, monkeypatch):
    rows = odd_texts() + [(100 + k, prose(k, 20 + 3 * k)) for k in range(50)]
    segments = token_files.token_segments(documents(spark, rows), tokenizer_path())
    segments.write.parquet(str(tmp_path / "segments"))
    got = token_files.read_token_segments(spark.read.parquet(str(tmp_path / "segments"))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_segments(rows)))


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, token_files.BLOCK, token_files.BLOCK + 1, 3 * token_files.BLOCK + 77])
def test_segments(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 50_256).astype(np.uint32)
    raw = token_files.write_segment(ids, np.array([n, 0]))
    back = token_files.read_segment(raw)
    assert (back.ids == ids).all() and back.lengths.tolist() == [n, 0] and raw == token_files.write_segment(ids, np.array([n, 0]))
    for k in range(-(-n // token_files.BLOCK)):
        assert (token_files.read_segment(raw, k).ids == ids[k * token_files.BLOCK : (k + 1) * token_files.BLOCK]).all()
    for at in {5, len(raw) // 2, len(raw) - 1}:
        with pytest.raises(token_files.DamagedSegment):
            token_files.read_segment(raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1 :])


def test_bpe(spark):
    tokenizer, v = Tokenizer.from_file(tokenizer_path()), load_vocabulary(tokenizer_path())
    r = random.Random(8)
    signs = [*"ab  \n\n\t'sreé²½Ⅷ中\U0001f642_1.,- \xa0\x85\x1c|#<", "<|endoftext|>", " the", "'ll", "́"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(600)] + [x for _, x in odd_texts() if x] + ["ab" * 900, "x" * 5000]
    docs = documents(spark, list(enumerate(texts)) * 2)
    got = docs.select("text", bpe.encode(docs, v, bpe.build_lexicon(docs, v, words=50)).alias("e")).collect()
    for row in got:
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids
        assert row.e.n_tokens == len(ids) and row.e.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.e.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_token_ids_leave_the_worker_a_few_texts_at_a_time(spark, monkeypatch):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = [(k, prose(k, 40)) for k in range(50)] + [(100 + k, t) for k, (_, t) in enumerate(odd_texts())] + [(None, "no key"), (1, prose(1, 40))]
    monkeypatch.setattr(bpe, "KNOWN_WITH_IDS", 8)  # so that chunks leave the cache as well
    out = bpe.stage(spark, documents(spark, rows), "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan  # that holds whole batches of ids, of 10,000 texts
    want = [(k, ids := tokenizer.encode(t or "", add_special_tokens=False).ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for k, t in rows]
    got = [(r.doc_id, list(r.ids), r.ids_sha256) for r in out.collect() if r.n_tokens == len(r.ids)]
    assert sorted(got, key=str) == sorted(want, key=str)


ODD_SIGNS = [*"ab  \n\n\t'sreé²½Ⅷ中\U0001f642_1.,- \xa0\x85\x1c|#<\0ÿþ", " the", "'ll", "́"]


def odd_words(seed, n, most=40):
    r = random.Random(seed)
    return sorted({"".join(r.choice(ODD_SIGNS) for _ in range(r.randrange(1, most))) for _ in range(n)})


def test_chunks_are_cut_with_the_tokenizers_bounds():
    import regex

    cuts = lambda parts: set(itertools.accumulate(map(len, parts)))
    for text in ["", " ", "\n", "a b", "a\nb c.", "a\n b", "a  b", "a\0b c", "\0", "a\xa0b", "é b\n\nc", *odd_words(3, 300)]:
        assert "".join(chunks(text)) == text and cuts(chunks(text)) <= cuts(regex.findall(PATTERN, text))


@pytest.mark.parametrize("merged", [False, True])
def test_chunks_go_through_the_library_together(monkeypatch, merged):
    """One call for many chunks; if a merge has the byte that stands between them, one for each pre-token."""
    import tokenizers

    source = json.loads(load_vocabulary(tokenizer_path()).text)
    if merged:
        mark = {b: c for c, b in byte_letters().items()}[0xFF]
        source["model"]["vocab"][mark * 2] = max(source["model"]["vocab"].values()) + 1
        source["model"]["merges"].append([mark, mark])
    source, calls = json.dumps(source), []

    class Counted:
        from_str = Tokenizer.from_str

        def __init__(self, model):
            self.real = Tokenizer(model)

        def encode_batch_fast(self, *args, **more):
            calls.append(1)
            return self.real.encode_batch_fast(*args, **more)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    new = sorted({c for w in odd_words(4, 400) for c in chunks(w)})
    got = token_files.library_encoder(source, {}).encode_new(new)
    plain = Tokenizer.from_str(source)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain.encode(c, add_special_tokens=False).ids for c in new]
    assert len(calls) == (0 if merged else -(-len(new) // token_files.TOGETHER))


def test_known_words_are_not_encoded_again(monkeypatch):
    """Behind a known word only the punctuation is new, in either half of the cache; the ids are the library's."""
    import tokenizers

    class Counted:
        from_str = Tokenizer.from_str

        def __init__(self, model):
            self.real = Tokenizer(model)

        def encode_batch_fast(self, *args, **more):
            calls.append(1)
            return self.real.encode_batch_fast(*args, **more)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    monkeypatch.setattr(token_files, "ENDS", 2)
    source, calls = load_vocabulary(tokenizer_path()).text, []
    plain, cached = Tokenizer.from_str(source), token_files.library_encoder(source, {})
    words = ["ab", " zqx", " \u00e9t\u00e9", " The"]
    cached.encode_new(words)
    cached.known.update(zip(words[:2], cached.encode_new(words[:2]), strict=True))
    cached.older.update(zip(words[2:], cached.encode_new(words[2:]), strict=True))
    calls.clear()
    new = [w + e for w in words for e in (".", ",", "!?", "...", ";")]
    got = cached.encode_new([*new, " other.", *new])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain.encode(c, add_special_tokens=False).ids for c in [*new, " other.", *new]]
    assert len(calls) == 1
    text = ["ab zqx, \u00e9t\u00e9. The; ab.", "", " The"]
    assert [np.frombuffer(b"".join(x), "<u4").tolist() for x in cached.encode(text)] == [plain.encode(t, add_special_tokens=False).ids for t in text]


def test_merger_looks_up_what_words_hold(monkeypatch):
    """A long word beside short ones does not widen their rows; the ids are those of single words."""
    v, looked, rank = load_vocabulary(tokenizer_path()), [], bpe.Merger._rank
    monkeypatch.setattr(bpe.Merger, "_rank", lambda self, a, b: looked.append(a.size) or rank(self, a, b))
    raw = [w.encode() for w in odd_words(5, 800)] + [b"ab", b"a", b"e" * 32, b"e" * 33, b"e" * 200, b""]
    merger = bpe.Merger(v)
    assert merger.words(raw) == [bpe.merge_word(w, v) for w in raw]
    looked.clear()
    short = [f"x{k}".encode() for k in range(1000)] + [b"e" * 32]
    merger.words(short)
    assert max(looked) <= 6 * len(short)


def test_chunks_that_do_not_decode_to_themselves():
    """Whole chunks are compared at once; one odd chunk among them changes no other."""
    v = load_vocabulary(tokenizer_path())
    cached = bpe.encoder(v, bpe.Lexicon.compile({}))
    new = [" the", "\ud800x", "é", " zzq."]
    got = cached.encode_new(new)
    assert got == [cached.encode_new([c])[0] for c in new]
    assert [b for _, b in got] == [" the", "\ufffd\ufffd\ufffdx", "é", " zzq."]


def test_lexicon():
    v = load_vocabulary(tokenizer_path())
    words = {w.encode(): bpe.merge_chunk(w, v) for w in ("tap", "taps", "top", "tops", " top", "stops", "é", "ta")}
    lexicon = bpe.mapped(bpe.Lexicon.compile(words))
    numbers = lexicon.find([*words, b"t", b"tapss", b"", b"zz"])
    assert sorted(numbers[: len(words)]) == list(range(len(words))) and (numbers[len(words) :] == -1).all()
    assert lexicon.outputs(numbers) == [*words.values(), None, None, None, None]
    # tap(s) and top(s) share what follows their second letter's successor: fewer states than a tree of letters.
    assert len(lexicon.final) < len({w[:k] for w in words for k in range(len(w) + 1)})
    assert (bpe.mapped(bpe.Lexicon.compile({})).find([b"a"]) == -1).all()


def plain_match(glob, text):
    import re

    return re.fullmatch("".join({"**": "(?s:.*)", "*": "[^/?]*"}.get(p, re.escape(p)) for p in re.findall(r"\*\*|\*|[^*]+", glob)), text) is not None


def test_automaton():
    r = random.Random(9)
    globs = ["".join(r.choice(["a", "b", "/", "*", "**", "é", "?"]) for _ in range(r.randrange(1, 9))) for _ in range(60)] + ["a" * 200 + "*", "", "**"]
    texts = ["".join(r.choice("ab/é?") for _ in range(r.randrange(12))) for _ in range(300)] + ["a" * 203, "\U0001f642" * 30]
    got = url_filters.Automaton(globs).match(texts)
    assert got.tolist() == [[plain_match(g, t) for g in globs] for t in texts]


def test_urls(spark):
    urls = [None, "", "no-scheme.net/x", "http://A.Net/", "http://net", "http://xnet/", "x://example.net/en/a?b", "x://example.net/enx", "x://a.example.com/de/", "x://org/fr/y#z", "x://com?q=a.net/", "x://ü.net/\n/", "a://b://c.net/"]
    df = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = [tuple(r) for r in url_filters.judge_urls(df).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.net", "/", "net/", "block"), ("net", "", None, "allow"), ("xnet", "/", None, "allow"),
        ("example.net", "/en/a", "example.net/en/", "allow"), ("example.net", "/enx", "net/", "block"), ("a.example.com", "/de/", "example.com/de/", "block"),
        ("org", "/fr/y", "org/fr/", "allow"), ("com", "", None, "allow"), ("ü.net", "/\n/", "net/", "block"), ("b:", "//c.net/", None, "allow"),
    ]


@pytest.mark.parametrize("rows", [200_000, 0])
def test_contaminated(spark, monkeypatch, rows):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows)
    items = [prose(50 + k, 40).split() for k in range(6)] + [prose(60, 7).split(), ["too", "few", "words"]]
    swapped = ["other" if k % 9 == 4 else w for k, w in enumerate(items[1])]
    texts = {
        1: [*prose(1, 50).split(), *items[0], *prose(2, 30).split()], 2: ["a", *swapped, "b"], 3: items[2][20:] + ["end"], 4: ["x", *items[6]], 5: [w.upper() for w in items[3]],
        6: items[4][:9] + prose(3, 60).split(), 7: items[7], 8: prose(4, 200).split(), 9: ["other" if k % 2 else w for k, w in enumerate(items[5])],
    }
    docs = documents(spark, [(k, " ".join(w)) for k, w in texts.items()] + [(10, None), (11, "")])
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_words, r.n_equal, r.place) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {(1, 0, 40, 40, 50), (2, 1, 40, 40 - sum(k % 9 == 4 for k in range(40)), 1), (3, 2, 20, 20, -20), (4, 6, 7, 7, 1), (5, 3, 40, 40, 0)}


def replaced(n):
    """All ways to replace as many of n words as the rule allows."""
    return itertools.combinations(range(n), n - -(-decontamination.AGREE * n // 100))


def test_no_passage_without_a_seed():
    """Wherever the replaced words of a stretch lie, a mask fits between them."""
    assert list(decontamination.MASKS) == list(range(decontamination.LEAST_WORDS, decontamination.STRETCH + 1))
    for n, masks in decontamination.MASKS.items():
        assert len({len(m) for m in masks}) == 1
        for gone in replaced(n):
            assert any(all(c == "0" or at + k not in gone for k, c in enumerate(m)) for m in masks for at in range(n - len(m) + 1)), (n, gone)


def brute_contaminated(docs, items):
    """The rule at every place of every item on every document."""
    out = set()
    for (d, x), (i, y) in itertools.product(docs, items):
        w, v = x.lower().split(), y.lower().split()
        need, found = min(decontamination.STRETCH, len(v)), []
        for place in range(-len(v) + 1, len(w)):
            equal = [v[j] == w[j + place] for j in range(max(-place, 0), min(len(v), len(w) - place))]
            if len(v) >= decontamination.LEAST_WORDS and any(100 * sum(equal[k : k + need]) >= decontamination.AGREE * need for k in range(len(equal) - need + 1)):
                found.append((-sum(equal), len(equal), place))
        if found:
            agree, n, place = min(found)
            out.add((d, i, n, -agree, place))
    return out


def test_all_replaced_words(spark):
    """Items of 5 to 18 words with all patterns of replaced words within the rule, and some beyond it."""
    items = [(n, prose(80 + n, n, 10**6)) for n in (5, 7, 9, 10, 11, 13, 15, 18)]
    texts = []
    for n, item in items:
        gone = list(replaced(min(n, 13))) + [(0, *g) for g in itertools.combinations(range(1, n), 3 if n >= 13 else 2)][::5]
        texts += ["before " + " ".join("other" if k in g else w for k, w in enumerate(item.split())) + " after" for g in gone]
    docs = list(enumerate(texts))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_words, r.n_equal, r.place) for r in decontamination.contaminated(documents(spark, docs), bench).collect()}
    assert got == brute_contaminated(docs, items) and len(got) < len(docs)


def test_pipeline(spark, tmp_path):
    """The stages one after the other by brute force."""
    item, secret = prose(70, 40), "token=0123456789abcdef0123456789abcdef"
    base = prose(71, 120).split()
    rows = [(k, " ".join(base[:-1] + [f"w{k}"])) for k in range(5, 9)] + [(20, prose(72, 90) + " " + item), (21, prose(73, 60) + " " + secret + " end"), (22, "12345 --"), (23, None), (24, prose(74, 70))]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    texts = {5: " ".join(base[:-1] + ["w5"]), 21: prose(73, 60) + " [secret] end", 24: prose(74, 70)}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    assert {k: r.ids for k, r in got.items()} == {k: tokenizer.encode(t, add_special_tokens=False).ids for k, t in texts.items()}
