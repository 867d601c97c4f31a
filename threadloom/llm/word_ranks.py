"""Ids of single words by ranks, for a byte-pair tokenizer whose words end in a marker.

The ``tokenizers`` file has an id for each byte, one for each byte that ends a word, and one for each merge, in the order of the merges. With the
marker written as byte FF, which no UTF-8 text has, ids are ranks in the sense of ``tiktoken``: joining a word's last byte with
the marker comes before all merges. The two libraries differ in one point. One joins a pair only if that very pair is a merge; the other
whenever the joined bytes are a token. Merging inside a token's bytes takes the same course wherever they stand, so a token is
reached through one pair only; where that isn't the pair of its merge, the first library never makes the token, and it is left out of the ranks.
Then both give the same ids.

Only words of Latin letters, digits and signs come here, whose normal forms and classes no version of Unicode changes; all else, and
special strings, stay with the library.
"""

from __future__ import annotations

import json
import struct

import regex

MARKER, SUFFIX = b"\xff", "</w>"
#: What a chunk may hold: no controls, no white space, nothing from U+0250 on.
PLAIN = regex.compile("[!-~¡-ɏ]+")
#: Signs that the pattern takes for a word of their own after letters.
STOPS = ".,;:!?)\""
#: Bytes that stand for themselves in the file's alphabet; the others follow from U+0100 on (fixed values of the format).
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_of() -> dict[str, int]:
    """The alphabet's letters and the bytes they stand for."""
    others = [b for b in range(256) if b not in PRINTED]
    return {chr(b): b for b in PRINTED} | {chr(256 + k): b for k, b in enumerate(others)}


def last_pair(token: bytes, merges: dict[tuple[bytes, bytes], int]) -> tuple[bytes, ...]:
    """The two parts of which the first library would make ``token``, or what it is left with."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((merges.get(pair, len(merges)), i) for i, pair in enumerate(zip(parts, parts[1:])))
        if rank == len(merges):
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts)


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordRanks:
    """``encode`` gives a plain chunk's ids as little-endian 32-bit bytes. ``None`` from ``of`` where the file is of another kind."""

    def __init__(self, pattern: str, ranks: dict[bytes, int]):
        import tiktoken

        self.words = regex.compile(pattern).findall
        self.ids = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    @classmethod
    def of(cls, path: str) -> WordRanks | None:
        try:
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            model, split, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0], [n["type"] for n in spec["normalizer"]["normalizers"]]
            if (model["type"], model["end_of_word_suffix"], split["behavior"], split["invert"], steps) != ("BPE", SUFFIX, "Removed", True, ["NFC", "Replace", "Lowercase"]):
                return None
            letters = byte_of()
            plain = lambda s: bytes(letters[c] for c in s.removesuffix(SUFFIX)) + (MARKER if s.endswith(SUFFIX) else b"")
            special = {t["content"] for t in spec["added_tokens"]}
            pairs = [tuple(map(plain, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
            ranks = {plain(s): i for s, i in model["vocab"].items() if s not in special}
            if any(ranks[a + b] != 512 + k for k, (a, b) in enumerate(pairs)) or any(ranks[bytes([b])] >= 256 or ranks[bytes([b]) + MARKER] >= 512 for b in range(255)):
                return None
        except (KeyError, TypeError, IndexError):
            return None
        merges = {(bytes([b]), MARKER): -1 for b in range(255)} | {p: k for k, p in enumerate(pairs)}
        for a, b in pairs:
            if last_pair(a + b, merges) != (a, b):
                del ranks[a + b]
        return cls(split["pattern"]["Regex"], ranks)

    def split(self, chunk: str) -> list[str]:
        """The pattern's words. Letters alone, or before one stop, are what most chunks are and need no pattern."""
        if chunk.isalpha():
            return [chunk]
        if chunk[-1] in STOPS and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.words(chunk)

    def encode(self, chunk: str, known: dict[str, bytes]) -> bytes:
        out = []
        for w in self.split(chunk.lower()):
            e = known.get(w)
            if e is None:
                e = known[w] = pack(self.ids(w.encode() + MARKER))
            out.append(e)
        return b"".join(out)
