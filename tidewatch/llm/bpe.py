"""Byte-pair encoding and decoding as streaming machines.

Encoding is a transducer with bounded lookahead.  Follow the merge list in
rank order on a known prefix and on any continuation of it: the two runs agree
left of a point that starts at the end of the prefix and moves left only when
a merge (u, v) crosses it, by the length of u.  The next merge that can cross
must take, as its right part, a token that begins with u; so the distance is
bounded by the longest chain of merges of rising rank in which each left part
begins the right part of the next.  ``MergeList.lookahead`` is that bound, a
constant of the merge list.  Tokens that end at least so far before the end of
what was read are final: the transducer emits them, drops their bytes and goes
on.  The split into pretokens, which no merge crosses, needs a lookahead of its
own: a blank after other than white space, else the length of a special token.
Both together form ``Transducer``: texts are read in chunks, every id comes out
of it, and what it holds doesn't grow with the text.  A bounded memory of the
ids of frequent pieces stands behind it.

Decoding is the reverse machine: ids to bytes to text, holding at most the
bytes of one unfinished character; ill-formed bytes become U+FFFD.

Defined results
  * null and empty texts: no ids, empty text;
  * the vocabulary's special tokens in a text get their own id, as in the
    ``tokenizers`` library's default;
  * very long texts are read and given out in parts; very long words, runs of
    white space or texts without any blank pass through in windows as well;
  * repeated rows and null doc_ids: each row is coded alone; an empty table
    gives no rows; other columns are not used.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .packing import default_tokenizer
from .tokens import WORDS, byte_letters, slices

#: What goes on with an endless pretoken: white space, letters, numbers, signs (fixed values of the split's rules).
KINDS = (r"\s+", r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")
#: Characters read at once, characters without a blank after which pretokens are ended without one, and bytes of a result batch.
CHUNK, FORCED, BATCH = 1 << 16, 4096, 4 << 20
#: Pieces and pretokens that a worker remembers, each of at most so many characters.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 48
CODED = "doc_id long, part int, last boolean, n_tokens long, ids binary, decoded string"
CODED_NAMES = ["doc_id", "part", "last", "n_tokens", "ids", "decoded"]


class MergeList:
    """Vocabulary and merges of a byte-level file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, letters = whole["model"], byte_letters()
        vocab: dict[str, int] = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.token_bytes: dict[int, bytes] = {}
        for text, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in text) if all(c in letters for c in text) else text.encode()
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.of_byte = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        #: pair -> rank and result in one number, least rank first.
        self.pairs = {a * self.size + b: (rank << 32) | c for rank, (a, b, c) in reversed([*enumerate(self.merges)])}
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int | None:
        """Bytes after which a token's end is final; None if a merge uses a token that only a later one makes."""
        left: dict[int, int] = {}  # the left part of each token made so far
        chain: dict[int, int] = {}  # longest chain whose last left part is this token
        known, longest = set(self.of_byte), 0
        for a, b, c in self.merges:
            if a not in known or b not in known:
                return None
            best, t = 0, b
            while t is not None:
                best, t = max(best, chain.get(t, 0)), left.get(t)
            reach = len(self.token_bytes[a]) + best
            chain[a] = max(chain.get(a, 0), reach)
            longest = max(longest, reach)
            if c not in known:
                known.add(c)
                left[c] = a
            elif left.get(c) != a:
                # A token made in two ways begins with either left part; keep the chains of both.
                chain[left[c]] = chain[a] = max(chain.get(left[c], 0), chain[a])
        return longest + max(len(self.token_bytes[c]) for _, _, c in self.merges)

    def merged(self, data: bytes) -> list[int]:
        """ids of ``data`` as one pretoken."""
        sym = [self.of_byte[b] for b in data]
        if len(sym) > 48:
            return self._queued(sym)
        get, size, none = self.pairs.get, self.size, 1 << 62
        # found[i] is the merge of sym[i] and sym[i + 1]; a merge changes it at two places only.
        found = [get(a * size + b, none) for a, b in zip(sym, sym[1:], strict=False)]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            sym[i : i + 2] = [best & 0xFFFFFFFF]
            del found[i]
            if i < len(found):
                found[i] = get(sym[i] * size + sym[i + 1], none)
            if i:
                found[i - 1] = get(sym[i - 1] * size + sym[i], none)
        return sym

    def _queued(self, sym: list[int]) -> list[int]:
        """The same by a queue of candidate pairs: least rank first, then leftmost."""
        get, size, n = self.pairs.get, self.size, len(sym)
        after, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
        queue = [(p, i, sym[i], sym[i + 1]) for i in range(n - 1) if (p := get(sym[i] * size + sym[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            p, i, a, b = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], after[i] = p & 0xFFFFFFFF, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := get(sym[i] * size + sym[after[i]])) is not None:
                    heapq.heappush(queue, (p, i, sym[i], sym[after[i]]))
            if (h := before[i]) >= 0 and (p := get(sym[h] * size + sym[i])) is not None:
                heapq.heappush(queue, (p, h, sym[h], sym[i]))
        return [s for s, live in zip(sym, alive, strict=True) if live]


class MergeMachine:
    """Bytes of one pretoken in, final ids out; holds less than ``window`` bytes."""

    def __init__(self, merges: MergeList, window: int | None = None):
        self.merges, self.held = merges, b""
        self.window = max(window or 0, 2 * merges.lookahead) if merges.lookahead is not None else None

    def feed(self, data: bytes) -> Iterator[int]:
        self.held += data
        while self.window is not None and len(self.held) >= self.window:
            final, at = self.window - self.merges.lookahead, 0
            for i in self.merges.merged(self.held[: self.window]):
                end = at + len(self.merges.token_bytes[i])
                if end > final:
                    break
                yield i
                at = end
            self.held = self.held[at:]

    def finish(self) -> Iterator[int]:
        yield from self.merges.merged(self.held)
        self.held = b""


class Pieces:
    """ids of text that begins and ends between pretokens: the merge machine's, behind a bounded memory of frequent pieces."""

    def __init__(self, path: str):
        import regex

        self.list = MergeList(path)
        self.words = regex.compile(WORDS)
        self.kinds = [regex.compile(k) for k in KINDS]
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.list.special, key=len, reverse=True))) if self.list.special else None
        #: What stands so far before the end of what was read is in a pretoken for good: a contraction or a special token may still come.
        self.margin = 1 + max([3, *map(len, self.list.special)])
        self.machine = MergeMachine(self.list, 2048)
        self.new: dict[str, bytes] = {}  # ids of a blank and the piece
        self.old: dict[str, bytes] = {}
        self.pretokens: dict[str, bytes] = {}

    def pretoken(self, word: str) -> bytes:
        """ids of one pretoken."""
        ids = self.pretokens.get(word)
        if ids is None:
            data, out = word.encode(), array("I")
            for start in range(0, len(data), 1 << 16):
                out.extend(self.machine.feed(data[start : start + (1 << 16)]))
            out.extend(self.machine.finish())
            ids = out.tobytes()
            if len(word) <= LONGEST_REMEMBERED:
                if len(self.pretokens) >= REMEMBERED:
                    self.pretokens.clear()
                self.pretokens[word] = ids
        return ids

    def parts(self, text: str) -> Iterator[tuple[int, int, str | None]]:
        """(start, end, special token or None) of what special tokens part."""
        at = 0
        for m in self.special.finditer(text) if self.special is not None else ():
            yield at, m.start(), None
            yield m.start(), m.end(), m.group()
            at = m.end()
        yield at, len(text), None

    def whole(self, text: str) -> bytes:
        out = []
        for a, b, special in self.parts(text):
            out += [array("I", [self.list.special[special]]).tobytes()] if special else [self.pretoken(m.group()) for m in self.words.finditer(text[a:b])]
        return b"".join(out)

    def _learned(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            # Most pieces are letters, perhaps with a stop or comma: one or two pretokens by the split's rules.
            if piece.isalpha():
                ids = self.pretoken(" " + piece)
            elif piece[-1] in ".," and piece[:-1].isalpha():
                ids = self.pretoken(" " + piece[:-1]) + self.pretoken(piece[-1])
            else:
                ids = self.whole(" " + piece)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.new) >= REMEMBERED:
                self.old, self.new = self.new, {}
            self.new[piece] = ids
        return ids

    def stable(self, text: str) -> bytes:
        """ids of whole pretokens, looked up between blanks."""
        pieces = text.split(" ")
        ids = [*map(self.new.get, pieces)]
        ids[0] = self.whole(pieces[0])
        if None in ids:
            for k, known in enumerate(ids):
                if known is None:
                    if not pieces[k] or pieces[k][0].isspace():  # a run of white space goes across the blank
                        return self.whole(text)
                    ids[k] = self._learned(pieces[k])
        return b"".join(ids)


class Transducer:
    """A text in chunks of any size in, final ids (32-bit, little-endian) out.

    A blank after other than white space parts pretokens whatever follows, so all before
    the last such blank is final.  Where none comes for ``FORCED`` characters, pretokens
    end where the split's rules say so, short of ``Pieces.margin``; a pretoken that goes on
    and on is fed to a merge machine of its own, which emits what its lookahead allows.
    """

    def __init__(self, pieces: Pieces):
        self.pieces, self.held = pieces, ""
        self.open: tuple[MergeMachine, object] | None = None  # of an endless pretoken, and the pattern of what goes on with it

    def feed(self, chunk: str) -> Iterator[bytes]:
        yield from self._run(self.held + chunk, False)

    def finish(self) -> Iterator[bytes]:
        yield from self._run(self.held, True)
        self.held, self.open = "", None

    def _run(self, text: str, last: bool) -> Iterator[bytes]:
        if self.open is not None:
            text = yield from self._on(text, last)
        if self.open is None:
            cut = len(text) if last else self._blank(text)
            if cut:
                yield self.pieces.stable(text[:cut])
                text = text[cut:]
            if not last and len(text) >= FORCED:
                text = yield from self._forced(text)
        self.held = text

    @staticmethod
    def _blank(text: str) -> int:
        at = text.rfind(" ")
        while at > 0 and text[at - 1].isspace():
            at = text.rfind(" ", 0, at)
        return max(at, 0)

    def _forced(self, text: str) -> Iterator[bytes]:
        """Emits all pretokens that are final without a blank, opens one that is very long, and returns what is left."""
        safe = len(text) - self.pieces.margin
        for a, b, special in self.pieces.parts(text):
            if special:
                yield array("I", [self.pieces.list.special[special]]).tobytes()
                continue
            for m in self.pieces.words.finditer(text, a, b):
                if m.end() <= safe or b < len(text):
                    yield self.pieces.pretoken(m.group())
                elif safe - m.start() < FORCED // 2:
                    return text[m.start() :]
                else:
                    machine = MergeMachine(self.pieces.list, 2048)
                    self.open = machine, next(k for k in self.pieces.kinds if k.match(text, safe - 1))
                    yield array("I", machine.feed(text[m.start() : safe].encode())).tobytes()
                    return text[safe:]
        return ""

    def _on(self, text: str, last: bool) -> Iterator[bytes]:
        """Goes on with the open pretoken, and returns what is left."""
        machine, kind = self.open
        special = self.pieces.special.search(text) if self.pieces.special is not None else None
        end = special.start() if special else len(text)
        run = kind.match(text, 0, end)
        to = run.end() if run else 0
        safe = len(text) - (0 if last else self.pieces.margin)
        if to > safe or to == len(text) and not last:
            to = max(safe, 0)
            yield array("I", machine.feed(text[:to].encode())).tobytes()
            return text[to:]
        if to < end and kind is self.pieces.kinds[0]:
            to = max(to - 1, 0)  # the last of white space belongs to what follows
        yield array("I", [*machine.feed(text[:to].encode()), *machine.finish()]).tobytes()
        self.open = None
        return text[to:]


class StreamDecoder:
    """ids in, text out; holds the bytes of one unfinished character at most."""

    def __init__(self, merges: MergeList):
        self.token_bytes = [merges.token_bytes.get(i, b"") for i in range(max(merges.token_bytes) + 1)]
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.token_bytes.__getitem__, ids)))

    def finish(self) -> str:
        text = self.machine.decode(b"", True)
        self.machine.reset()
        return text


@lru_cache(maxsize=1)
def coders_for(path: str) -> tuple[Pieces, StreamDecoder]:
    """This process's tables, kept while a Python worker is reused."""
    pieces = Pieces(path)
    return pieces, StreamDecoder(pieces.list)


def _coded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces, decoder = coders_for(path)
    rows: list[list] = [[] for _ in CODED_NAMES]
    size = 0

    def batch() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.string())
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=CODED_NAMES)
        for c in rows:
            c.clear()
        return out

    for whole in batches:
        for some in slices(whole, "text"):
            for doc_id, scalar in zip(some["doc_id"].to_pylist(), some["text"], strict=True):
                text = scalar.as_py() or ""
                machine, part = Transducer(pieces), 0
                for start in range(0, max(1, len(text)), CHUNK):
                    last = start + CHUNK >= len(text)
                    ids = b"".join(machine.feed(text[start : start + CHUNK]))
                    if last:
                        ids += b"".join(machine.finish())
                    plain = decoder.feed(array("I", ids)) + (decoder.finish() if last else "")
                    for c, value in zip(rows, (doc_id, part, last, len(ids) // 4, ids, plain), strict=True):
                        c.append(value)
                    part, size = part + 1, size + len(ids) + len(plain)
                    if size > BATCH or len(rows[0]) >= 1024:
                        yield batch()
                        size = 0
    if rows[0]:
        yield batch()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def coded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """ids (32-bit little-endian) of every text and the text that they decode to, one row for each ``CHUNK`` characters read.

    The parts of a text follow each other in one partition, from 0 on; ``last`` marks its end.
    """
    path = tokenizer or default_tokenizer()
    return _rows(docs).mapInArrow(lambda batches: _coded(batches, path), CODED)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in their order to one row a text; sums and hashes run along, so no text is put together."""
    n, ids, plain = 0, hashlib.sha256(), hashlib.sha256()
    for batch in batches:
        out: list[list] = [[] for _ in range(4)]
        for doc_id, last, n_tokens, own, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "last", "n_tokens", "ids", "decoded")), strict=True):
            n += n_tokens
            ids.update(own)
            plain.update(text.encode())
            if last:
                for c, value in zip(out, (doc_id, n, ids.hexdigest(), plain.hexdigest()), strict=True):
                    c.append(value)
                n, ids, plain = 0, hashlib.sha256(), hashlib.sha256()
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digested(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: ``coded`` with the hashes taken in the same worker."""
    path = tokenizer or default_tokenizer()
    return _rows(docs).mapInArrow(lambda batches: digests(_coded(batches, path)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    return digested(table(spark, sf_dir, "documents"))
