"""A byte-level BPE vocabulary read from a tokenizers JSON file, and how its texts fall into words.

The file's path is a parameter; the vocabulary is never copied into the repository.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex

# The word pattern of byte-level BPE vocabularies of this kind.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

WORDS = regex.compile(WORD_PATTERN)
NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in such files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class ByteBPE:
    """Vocabulary, merge ranks and special strings; arrays for batched and dicts for single-word merging."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        of = {c: b for b, c in enumerate(byte_symbols())}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.byte_ids = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.token_bytes: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(of[c] for c in token)
        self.by_rank = made.tolist()
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.byte_list = self.byte_ids.tolist()
        for token, i in self.special.items():
            self.token_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()

    def words(self, text: str) -> list[str]:
        """The words of a text; special strings are words of their own."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return WORDS.findall(text)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += [*WORDS.findall(text[at : m.start()]), m[0]]
            at = m.end()
        return out + WORDS.findall(text[at:])


EXACT_CUTS = re.compile(r"(?<=\S)(?= )")
_BESIDE = re.compile(r"[^\S ] | [^\S ]")


def _runs(text: str) -> bool:
    """Whether a space stands beside white space or at either end: cuts before all spaces may part a word then.

    A printable text has no white space but spaces.
    """
    return "  " in text or text[:1] == " " or text[-1:] == " " or (not text.isprintable() and _BESIDE.search(text) is not None)


def pieces(text: str, known: dict, special: regex.Pattern | None = None) -> tuple[list[str], set[str]]:
    """Cut a text before single spaces; also gives the distinct pieces that aren't known.

    No word of the pattern reaches over a cut between a character other than white space and a space: white space never
    follows such a character inside a word, and what a run of white space becomes is settled by the run and what follows.
    Texts in which a space stands beside other white space or that hold a special string are cut where this is so; others
    before every space, which comes to the same. Only the text decides how it is cut, not what is known.
    """
    if _runs(text) or (special is not None and special.search(text)):
        out = [p for p in EXACT_CUTS.split(text) if p]
    else:
        parts = text.split(" ")
        out = parts[:1] + [" " + p for p in parts[1:]]
    return out, set(out).difference(known)
