"""Whole texts to token ids with a file of the ``tokenizers`` library.

A text is cut where that cannot change its ids, and each distinct piece is
encoded once per worker; a bounded two-generation memory keeps the ids of
frequent pieces.  Texts that cannot be cut safely go to the library whole.
Byte-level files whose ids are their merge ranks let ``tiktoken`` encode whole
texts, which gives the same ids sooner and remembers nothing; only texts that
may hold a special token or have very long runs are cut into pieces.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A worker remembers this many pieces in each of two generations (with its vocabularies some 220 MB, while pieces last that differ).
REMEMBERED = 350_000
#: Longer pieces are encoded each time, so that memory stays bounded.
LONGEST_REMEMBERED = 48
#: A text with a longer run of bytes without ASCII white space, or of it alone, is not encoded whole: the work on a run may grow with its square.
LONGEST_RUN = 1_000
KINDS = bytes(32 if b == 32 or 9 <= b <= 13 else 120 for b in range(256))
LONG_BLANK, LONG_WORD = b" " * LONGEST_RUN, b"x" * LONGEST_RUN
#: Texts are handled in groups of at most so many characters or rows.
GROUP_CHARS, GROUP_ROWS = 4_000_000, 1024

#: The byte-level split of text into words, numbers, signs and blanks (fixed value).
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The split of a word-end vocabulary, after white space became spaces and letters small (fixed value).
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Two signs side by side (marks on letters count as signs here, and so do U+001C to U+001F, which are no white space to the library).
SIGNS = re.compile(r"(?:[^\w\s]|[\x1c-\x1f]){2}|_")


_SIGN = bytes(95 if chr(b) == "_" else 33 if SIGNS.match(chr(b) * 2) else 120 for b in range(128)) + bytes(128)


def two_signs(text: str) -> bool:
    """What ``SIGNS`` finds, of ASCII text."""
    kinds = text.encode().translate(_SIGN)
    return b"!!" in kinds or b"_" in kinds


def byte_letters() -> dict[str, int]:
    """A byte-level vocabulary's letter for each byte: itself if printable, else the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class PieceEncoder:
    """ids of whole texts as little-endian bytes.

    ``spaced``: pieces keep the space before them, as byte-level vocabularies
    need; otherwise white space is dropped, as word-end vocabularies do.
    """

    def __init__(self, path: str, spaced: bool, code: str = "I"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.spaced, self.code = spaced, code
        # A special token can stand between pieces: the library encodes what lies between two of them apart.
        self.mark_text = "<|endoftext|>"
        self.mark = self.library.token_to_id(self.mark_text)
        self.ranked = self._ranked(path) if spaced else None
        self.worded, self.ends = (None, None) if spaced else self._worded(path)
        self.line_end = self.ranked.encode_single_token("\n") if self.ranked else None
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _ranked(self, path: str):
        """A ``tiktoken`` encoding of a byte-level file, or None if its ids aren't its merge ranks."""
        try:
            import tiktoken
        except ImportError:
            return None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, letters = model["vocab"], byte_letters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if sorted(vocab[c] for c in letters) != [*range(256)] or any(vocab[a + b] != 256 + n for n, (a, b) in enumerate(merges)):
            return None
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocab.items() if i < 256 + len(merges)}
        return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def _worded(self, path: str):
        """A ``tiktoken`` encoding of words of ASCII letters for a word-end file, and which ids end a word; or two Nones.

        A zero byte stands for the word's end.  Its pairs with a last letter have the least ranks, so they
        are joined first; then the merges follow in their order.
        """
        try:
            import tiktoken
        except ImportError:
            return None, None
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, letters = whole["model"], byte_letters()
        vocab, end = model["vocab"], model.get("end_of_word_suffix")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        splits = [s["pattern"].get("Regex", "") for s in (whole["pre_tokenizer"] or {}).get("pretokenizers", []) if s["type"] == "Split"]
        if end != "</w>" or splits != [WORD_SPLIT] or model.get("ignore_merges") or {"type": "Lowercase"} not in (whole["normalizer"] or {}).get("normalizers", []):
            return None, None
        if sorted(vocab[c] for c in letters) != [*range(256)] or sorted(vocab[c + end] for c in letters) != [*range(256, 512)] or any(vocab[a + b] != 512 + n for n, (a, b) in enumerate(merges)):
            return None, None
        known = [(t, i) for t, i in vocab.items() if i < 512 + len(merges)]
        ranks = {bytes(map(letters.__getitem__, t.removesuffix(end))) + b"\0" * t.endswith(end): i for t, i in known}
        if len(ranks) != len(known):
            return None, None
        ends = np.zeros(512 + len(merges), bool)
        ends[[i for t, i in known if t.endswith(end)]] = True
        return tiktoken.Encoding("words", pat_str="[a-z]+\0", mergeable_ranks=ranks, special_tokens={}), ends

    def _by_word(self, words: list[str]) -> list[bytes]:
        """ids of words of small ASCII letters."""
        out: list[bytes] = []
        for start in range(0, len(words), 4096):
            some = words[start : start + 4096]
            ids = np.array(self.worded.encode_ordinary("\0".join([*some, ""])), self.code)
            cuts, raw = [0, *((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()], ids.tobytes()
            if len(cuts) != len(some) + 1:
                raise ValueError("a word has no end")
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def _plain(self, text: str) -> bool:
        """True if ``tiktoken`` may encode ``text`` at once: no special token can stand there, and no run is long."""
        if "<|" in text:
            return False
        kinds = text.encode().translate(KINDS)
        return LONG_BLANK not in kinds and LONG_WORD not in kinds

    def _by_rank(self, pieces: list[str]) -> list[bytes]:
        """The same for pieces without line ends, which stand between them in one call."""
        out: list[bytes] = []
        for start in range(0, len(pieces), 4096):
            some = pieces[start : start + 4096]
            ids = np.array(self.ranked.encode_ordinary(" " + "\n ".join(some)), self.code)
            out += self._parted(ids, self.line_end, len(some))
        return out

    def _parted(self, ids: np.ndarray, mark: int, n: int) -> list[bytes]:
        ends = [*np.flatnonzero(ids == mark).tolist(), len(ids)]
        if len(ends) != n:
            raise ValueError("a piece holds the mark")
        width, raw, at, out = ids.itemsize, ids.tobytes(), 0, []
        for end in ends:
            out.append(raw[at * width : end * width])
            at = end + 1
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """ids of each piece, most of them by one call with a mark between pieces."""
        lead = " " if self.spaced else ""
        if self.ranked is not None:
            alone = [i for i, p in enumerate(pieces) if "\n" in p or "<|" in p or len(p) > LONGEST_REMEMBERED]
            if not alone:
                return self._by_rank(pieces)
            found, apart = dict(zip(alone, self._whole([lead + pieces[i] for i in alone]), strict=True)), set(alone)
            rest = iter(self._by_rank([p for i, p in enumerate(pieces) if i not in apart]))
            return [found[i] if i in found else next(rest) for i in range(len(pieces))]
        if self.worded is not None:
            words = [p for p in pieces if len(p) <= LONGEST_REMEMBERED and p.isascii() and p.isalpha()]
            found = dict(zip(words, self._by_word([p.lower() for p in words]), strict=True))
            if rest := [p for p in pieces if p not in found]:
                found.update(zip(rest, self._by_library(rest, lead), strict=True))
            return [found[p] for p in pieces]
        return self._by_library(pieces, lead)

    def _by_library(self, pieces: list[str], lead: str) -> list[bytes]:
        if self.mark is None:
            return self._whole([lead + p for p in pieces])
        alone = [i for i, p in enumerate(pieces) if self.mark_text[:2] in p or len(p) > LONGEST_REMEMBERED]
        apart = set(alone)
        joined = [lead + p for i, p in enumerate(pieces) if i not in apart] if apart else [lead + p for p in pieces]
        out: list[bytes] = []
        for start in range(0, len(joined), 4096):
            some = joined[start : start + 4096]
            ids = np.array(self.library.encode_batch_fast([self.mark_text.join(some)], add_special_tokens=False)[0].ids, self.code)
            out += self._parted(ids, self.mark, len(some))
        if apart:
            found, rest = dict(zip(alone, self._whole([lead + pieces[i] for i in alone]), strict=True)), iter(out)
            out = [found[i] if i in found else next(rest) for i in range(len(pieces))]
        return out

    def _words(self, text: str) -> list[str]:
        """Pieces for a vocabulary that composes marks, drops white space and case.

        Small letters and parted signs make fewer pieces differ.  They are used where they
        can't change ids: not where a special token may stand, since the library looks for
        these before it folds, not with a capital sigma, whose small letter depends on its
        place in Python, nor where composing marks would change the text.
        """
        small = text.lower()
        if "<|" not in text and "\u03a3" not in text and (text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", small)):
            text = small
            if not (two_signs(text) if text.isascii() else SIGNS.search(text)):  # every sign stands alone, so it is a token of its own wherever it is
                text = text.replace(".", " . ").replace(",", " , ")
        return text.replace("\n", " ").split(" ")

    def _unsafe(self, piece: str) -> bool:
        """True if white space around this piece could join with its neighbours'."""
        return self.spaced and (not piece or piece[0].isspace())

    def group(self, texts: list[str]) -> list[bytes]:
        """ids of each text of a bounded group."""
        if self.ranked is None:
            return self._cut(texts)
        out = [self._bytes(self.ranked.encode_ordinary(t)) if self._plain(t) else None for t in texts]
        if rest := [t for t, ids in zip(texts, out, strict=True) if ids is None]:
            found = iter(self._cut(rest))
            out = [next(found) if ids is None else ids for ids in out]
        return out

    def _cut(self, texts: list[str]) -> list[bytes]:
        """The same by pieces of the texts."""
        if self.spaced:
            # The first piece has no space before it: it is looked up under a key of its own.
            pieces = [t.split(" ") for t in texts]
            heads = [p[0] for p in pieces]
            tails = [p[1:] for p in pieces]
        else:
            tails, heads = [self._words(t) for t in texts], []
        need: set[str] = set()
        for p in tails:
            need.update(p)
        need.difference_update(self.new)
        whole = {p for p in need if self._unsafe(p)}
        need -= whole
        old, new = self.old, self.new
        asked = []
        for p in need:
            if (ids := old.get(p)) is not None:
                new[p] = ids
            else:
                asked.append(p)
        if asked:
            new.update(zip(asked, self._pieces(asked), strict=True))
        get = new.__getitem__
        if not self.spaced:
            out = [b"".join(map(get, p)) for p in tails]
        else:
            odd = [bool(whole) and not whole.isdisjoint(p) for p in tails]
            starts = self._whole([t if o else h for t, h, o in zip(texts, heads, odd, strict=True)])
            out = [s if o else s + b"".join(map(get, p)) for s, p, o in zip(starts, tails, odd, strict=True)]
        for p in asked:
            if len(p) > LONGEST_REMEMBERED:
                del new[p]
        if len(new) > REMEMBERED:
            self.old, self.new = new, {}
        return out

    def __call__(self, texts: Iterable[str]) -> Iterator[bytes]:
        for group in grouped(texts):
            yield from self.group(group)


@lru_cache(maxsize=2)
def encoder_for(path: str, spaced: bool, code: str) -> PieceEncoder:
    """This process's encoder: a reused Python worker keeps its vocabulary and its memory of pieces."""
    return PieceEncoder(path, spaced, code)


def forget() -> None:
    """Gives back what this process's encoders hold.

    Reused workers outlive a stage; one that turns to other work shouldn't keep
    vocabularies and pieces beside it.
    """
    if encoder_for.cache_info().currsize:
        encoder_for.cache_clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Returns memory that is free in this process, but held by its allocators, to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def grouped(texts: Iterable[str]) -> Iterator[list[str]]:
    """Runs of texts, null as empty, of bounded rows and characters (one long text may exceed the latter)."""
    group: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if group and (size + len(text) > GROUP_CHARS or len(group) >= GROUP_ROWS):
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` of bounded rows and bytes of ``text``; what they left free goes back to the system after the last."""
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and (size + n > GROUP_CHARS or i - start >= GROUP_ROWS):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield batch.slice(start)
    give_back()
