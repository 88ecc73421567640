"""Token ids of texts with public tokenizers, inside tasks.

``WordTokenizer`` gives the ids of the lower-casing word BPE file, the same as its library gives for a whole text, but
faster: what stands between blanks has its ids whatever is around it, so they are kept. New ones are cut by the file's own pattern and merged by a
byte-pair encoder whose ranks are the file's ids: a word ends in a byte no text has, and joining it to the last byte comes
first. Texts with characters outside the plain ranges below (where libraries could differ in normal forms or character
classes), or with a special token's string, go to the library itself.
"""

from __future__ import annotations

import base64
import json
import re
from array import array

import numpy as np

#: Printable ASCII, Latin letters and common punctuation: in normal form C, and in the same classes everywhere.
_PLAIN = r"[\t\n\r\x20-\x7e\xa1-įı-ɏ‐-‧‰-⁞]*"
#: Words kept in a worker; further ones are encoded each time.
MOST_KEPT = 400_000


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level files write bytes: printable ones stand for themselves, the others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in printable]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of the word BPE file as little-endian unsigned 32-bit bytes."""

    END = "</w>"

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        ranks: dict[bytes, int] = {}
        for token, number in spec["model"]["vocab"].items():
            if token in {t["content"] for t in spec["added_tokens"]}:
                continue
            end = token.endswith(self.END) and token != self.END
            ranks[bytes(letters[c] for c in (token[:-4] if end else token)) + b" " * end] = number
        space = max(ranks.values()) + 10
        ranks[b" "] = space
        self.last = np.zeros(space + 1, bool)
        self.last[[n for token, n in ranks.items() if token[-1:] == b" "]] = True
        self.encoder = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.plain = re.compile(_PLAIN).fullmatch
        self.kept: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if not self.plain(text) or any(t in text for t in self.specials):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        words, kept = text.lower().split(), self.kept
        try:
            return b"".join([kept[w] for w in words])
        except KeyError:
            new = self._new([w for w in set(words) if w not in kept])
        if len(kept) + len(new) <= MOST_KEPT:
            kept.update(new)
            return b"".join([kept[w] for w in words])
        return b"".join([new[w] if w in new else kept[w] for w in words])

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """One call for many words: every piece ends in an id of ``last``, so the ids can be dealt to the words."""
        pieces = [[w] if w.isalpha() else self.pieces(w) for w in words]
        ids = np.asarray(self.encoder.encode_ordinary("".join([f"{x} " for found in pieces for x in found])), "<u4")
        ends = np.concatenate(([0], np.flatnonzero(self.last[ids]) + 1))
        upto = (4 * ends[np.cumsum([0, *map(len, pieces)])]).tolist()
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, upto, upto[1:])}


class BytePairCounter:
    """Number of ids a rank file gives for a text; strings of special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        return self.encoder.encode_ordinary(text)

    def text(self, ids: list[int]) -> str:
        return self.encoder.decode(ids)


_MADE: dict[tuple[str, str], object] = {}


def once(kind: type, path: str):
    """One tokenizer per worker process and file (this module is imported by name there, so the store outlives a task)."""
    key = (kind.__name__, path)
    if key not in _MADE:
        _MADE[key] = kind(path)
    return _MADE[key]
