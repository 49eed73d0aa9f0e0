"""Texts cut where no token of a byte-level BPE tokenizer can reach across."""

import json
import re
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import regex

#: How a byte-level BPE tokenizer of this kind splits a text (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a Python worker keeps in a cache, in both halves of it.
CACHED = 400_000

_kept: dict[str, object] = {}


def kept(name: str, make):
    """What `make` gives, kept in a Python worker from task to task under a name that tells its contents."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary(NamedTuple):
    """What a tokenizer's file holds; read once on the driver."""

    text: str
    tokens: list[bytes]
    #: two neighbours (as left << 20 | right) to the rank of their merge and what it gives (as rank << 20 | id)
    merges: dict[int, int]
    bytes_: list[int]
    added: dict[str, int]


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level tokenizers write the 256 bytes: printable ones as themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_vocabulary(path: str) -> Vocabulary:
    text = Path(path).read_text(encoding="utf-8")
    model, letters = json.loads(text), byte_letters()
    vocab, added = model["model"]["vocab"], {t["content"]: t["id"] for t in model["added_tokens"]}
    tokens = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, k in vocab.items():
        tokens[k] = token.encode() if token in added else bytes(letters[c] for c in token)
    for token, k in added.items():
        tokens[k] = token.encode()
    merges = {}
    for rank, pair in enumerate(model["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocab[left] << 20 | vocab[right]] = rank << 20 | vocab[left + right]
    by_byte = {b: vocab[c] for c, b in letters.items()}
    return Vocabulary(text, tokens, merges, [by_byte[b] for b in range(256)], added)


#: All white space but blanks and line ends, and what of those is not one alone.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"] + ["  ", " \n", "\n ", "\n\n"]


def _plain(text: str) -> bool:
    """Whether all white space is one blank between two words or one line end between two lines."""
    return text != "" and not (text[0].isspace() or text[-1].isspace()) and not any(map(text.__contains__, _OTHER_SPACE))


def chunks(text: str) -> list[str]:
    """`text` in pieces that are encoded each on its own: words with the blank before them, and line ends.

    Texts with any other white space, or with the mark of the cuts, are cut by the full pattern.
    """
    if "\0" in text or not _plain(text):
        return regex.findall(PATTERN, text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def pre_tokens(chunk: str) -> list[str]:
    """What the pattern finds in a chunk; the common form, letters and then some punctuation, without it."""
    if (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
        return [chunk]
    stem = chunk.rstrip(".,;:!?|*#$%&")
    if stem.lstrip(" ").isalpha() and stem.count(" ") <= 1:
        return [stem, chunk[len(stem) :]] if len(stem) < len(chunk) else [stem]
    return regex.findall(PATTERN, chunk)


def pieces(text: str, added: dict[str, int]) -> list[tuple[str, int | None]]:
    """`text` between the added tokens in it, each piece with the id of the token after it."""
    if not any(t in text for t in added):
        return [(text, None)]
    cut = re.split("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")", text)
    return [(cut[k], added[cut[k + 1]] if k + 1 < len(cut) else None) for k in range(0, len(cut), 2)]


class Cached:
    """`encode_new` (a list of chunks to a list of what each comes to) behind a bounded cache.

    `special` gives what an added token comes to. The cache has two halves: when the younger one is full
    it becomes the older one, and what is asked for again moves back to the younger, so that frequent
    chunks stay.
    """

    def __init__(self, encode_new, added: dict[str, int], special=lambda k: [k], most: int | None = None):
        self.encode_new, self.added, self.special, self.most, self.known, self.older = encode_new, added, special, most, {}, {}

    def encode(self, texts: list[str]) -> list[list]:
        """For each text what each of its chunks comes to."""
        cut = [[(chunks(p), special) for p, special in pieces(t, self.added)] for t in texts]
        if len(self.known) > (self.most or CACHED) // 2:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for c in set().union(*[p for text in cut for p, _ in text]).difference(known):
            if (found := older.get(c)) is not None:
                known[c] = found
            else:
                new.append(c)
        for at in range(0, len(new), 20_000):
            block = new[at : at + 20_000]
            known.update(zip(block, self.encode_new(block), strict=True))
        found = known.__getitem__
        return [
            list(map(found, text[0][0]))
            if len(text) == 1
            else list(chain.from_iterable([*map(found, p), *([self.special(k)] if k is not None else [])] for p, k in text))
            for text in cut
        ]
