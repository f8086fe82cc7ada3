"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

For byte-level merges by rank, a token sequence is the encoding of its bytes just when each two neighbours are the
encoding of theirs. So every prefix of a piece has one last token, found from the last tokens of shorter prefixes. The
transducer reads a piece byte by byte; its state is the last token it has emitted and the bytes after it. A token leaves
as soon as every prefix from which a longer token could still start agrees on it, so no state holds more bytes than the
longest token has. States and their moves are made when first met, and dropped together when there are too many.
"""

from __future__ import annotations

import base64
import gc
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import kept, sliced

#: Half of the most pieces a worker remembers; states and pairs follow it. Beyond, it starts anew.
PIECES = 350_000
#: Stands for a prefix in which no live token ends.
NO_TOKEN = (-1, -2)
BYTES = [bytes((k,)) for k in range(256)]
EMIT = 24
MASK = (1 << EMIT) - 1


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and number on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most: int = 150_000) -> None:
        self.most = most
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        self.starts = {token[:k] for token in ranks for k in range(1, len(token))}
        self.fits: dict[tuple[int, int], bool] = {}
        self.made: dict[int, tuple[int, int]] = {}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple[int, bytes], int] = {}
        #: Of each state: its last token, the bytes after it, for each prefix of these the start and the token of its end,
        #: and the prefixes after which a token may start that isn't over.
        self.about: list[tuple[int, bytes, list[tuple[int, int]], list[int]]] = []
        #: By state and byte: the next state, and in the low bits the number of what is emitted, 0 for nothing.
        self.moves: dict[int, int] = {}
        self.emitted: dict[tuple[int, ...], int] = {(): 0}
        self.emits: list[tuple[int, ...]] = [()]
        self.ends: list[tuple[int, ...] | None] = []
        self._state(-1, b"", [(-1, -1)], [0])

    def _state(self, last: int, rest: bytes, lasts: list[tuple[int, int]], live: list[int]) -> int:
        key = last, rest
        if key not in self.number:
            self.number[key] = len(self.about)
            self.about.append((last, rest, lasts, live))
            self.ends.append(None)
        return self.number[key]

    def _rank(self, data: bytes, without: int) -> int:
        rank = self.ranks.get(data, 1 << 60)
        return 1 << 60 if rank == without else rank

    def merge(self, data: bytes, without: int = -1) -> list[int]:
        """Merges by rank, the plain definition, short of one token; used on the bytes of tokens only."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self._rank(a + b, without), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes a token; a single byte is its own half."""
        found = self.made.get(token)
        if found is None:
            data = self.tokens[token]
            if len(data) == 1:
                found = token, token
            else:
                parts = self.merge(data, token)
                found = (parts[0], parts[1]) if len(parts) == 2 else (-3, -3)
            self.made[token] = found
        return found

    def _fit(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens encode to just these: no merge over their border comes before their own.

        Where they meet, each side grows from a byte through later and later merges. Going back from the whole tokens,
        the later of the two merges is undone, and the pair that then meets must not have merged earlier than that.
        """
        key = a, b
        known = self.fits.get(key)
        if known is not None:
            return known
        if len(self.fits) > 2 * self.most:
            self.fits.clear()
        ranks, tokens, ok, until = self.ranks, self.tokens, a >= 0, 1 << 60
        while ok:
            across = ranks.get(tokens[a] + tokens[b])
            if across is not None and across < until:
                ok = False
                break
            left, right = self._halves(a)[1], self._halves(b)[0]
            if left == -3 or right == -3:
                ok = self.merge(tokens[key[0]] + tokens[key[1]]) == [*key]
                break
            if left == a and right == b:
                break
            # Of two merges of one rank the left one comes first, so the right one is undone first.
            if right != b and (left == a or b >= a):
                b, until = right, b + 1
            else:
                a, until = left, a
        ok = ok or key[0] < 0
        self.fits[key] = ok
        return ok

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, rest, lasts, live = self.about[state]
        rest += BYTES[byte]
        end, ranks, starts, fits = len(rest), self.ranks, self.starts, self.fits
        newest, alive = NO_TOKEN, []
        for start in live:
            part = rest[start:]
            if part in starts:
                alive.append(start)
            if newest is NO_TOKEN and part in ranks:
                key = lasts[start][1], ranks[part]
                fit = fits.get(key)
                if fit or fit is None and self._fit(*key):
                    newest = start, key[1]
        lasts = [*lasts, newest]
        if newest is not NO_TOKEN:
            alive.append(end)
        cut = alive[0]
        if cut:  # else find the longest prefix that all live prefixes go through
            for top in alive[1:]:
                while top != cut:
                    if top > cut:
                        top = lasts[top][0]
                    else:
                        cut = lasts[cut][0]
        if not cut:
            return self._state(last, rest, lasts, alive), ()
        sure, k = [], cut
        while k > 0:
            k, token = lasts[k]
            sure.append(token)
        sure.reverse()
        # Prefixes whose tokens start before the cut are on no live path. The last token counts only while one may start after it.
        last = lasts[cut][1] if alive[0] == cut else NO_TOKEN[1]
        kept = [(-1, last)]
        for start, token in lasts[cut + 1 :]:
            kept.append((start - cut, token) if start >= cut else NO_TOKEN)
        return self._state(last, rest[cut:], kept, [k - cut for k in alive]), tuple(sure)

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The tokens of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.about) > self.most:
            self._reset()
        state, out, moves, emits = 0, [], self.moves, self.emits
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                after, sure = self._move(state, byte)
                at = self.emitted.setdefault(sure, len(emits))
                if at == len(emits):
                    emits.append(sure)
                move = moves[state << 8 | byte] = after << EMIT | at
            state = move >> EMIT
            if move & MASK:
                out += emits[move & MASK]
        if self.ends[state] is None:
            _, rest, lasts, _ = self.about[state]
            path, k = [], len(rest)
            while k > 0:
                k, token = lasts[k]
                path.append(token)
            self.ends[state] = tuple(path[::-1])
        return (*out, *self.ends[state])


LETTER, NUMBER, BLANK = 1, 2, 3
_kinds: np.ndarray | None = None


def kinds() -> np.ndarray:
    """Letter, number, blank or other (0), for every code point."""
    global _kinds
    if _kinds is None:
        table = np.zeros(0x110000, np.uint8)
        for first in range(0, 0x110000, 4096):  # in parts, or a worker would hold a million strings at once
            if 0xD800 <= first < 0xE000:
                continue
            part = "".join(map(chr, range(first, first + 4096)))
            for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
                for m in regex.finditer(pattern, part):
                    table[first + m.start() : first + m.end()] = kind
        _kinds = table
    return _kinds


_SHORT, _LONG = [ord(c) for c in "stmd"], [(ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l"))]


def pieces(text: str) -> list[str]:
    """The matches of the split pattern in a text, found by runs of one kind.

    A run of letters, of numbers or of others takes one space before it; of other blanks before it, the last stands alone;
    an apostrophe that starts a match takes a short ending (s, t, m, d, re, ve, ll) from the letters after it.
    """
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = kinds()[codes]
    cut = np.empty(len(codes) + 1, bool)
    cut[0] = cut[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:-1])
    starts = np.flatnonzero(cut[:-1])
    after = starts[(starts > 0) & (kind[starts] != BLANK)]  # runs of non-blanks; those after a blank
    after = after[kind[after - 1] == BLANK]
    cut[after - 1] = True
    cut[after[codes[after - 1] == 32]] = False
    quote = np.flatnonzero((codes[:-1] == 39) & cut[:-2] & cut[1:-1] & (kind[1:] == LETTER))
    for q in quote.tolist():
        if int(codes[q + 1]) in _SHORT:
            cut[q + 1], cut[q + 2] = False, True
        elif q + 2 < len(codes) and (int(codes[q + 1]), int(codes[q + 2])) in _LONG:
            cut[q + 1], cut[q + 3] = False, True
    at = np.flatnonzero(cut).tolist()
    return [text[a:b] for a, b in zip(at, at[1:], strict=False)]


class Encoder(dict):
    """Tokens of pieces, kept up to a bound; the encoder of whole texts."""

    def __init__(self, ranks: dict[bytes, int], remember: int = PIECES) -> None:
        super().__init__()
        self.machine, self.older, self.most = Transducer(ranks, 3 * remember // 4), {}, remember

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            found = self.machine.encode(piece.encode())
        self[piece] = found
        return found

    def ids(self, text: str | None) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.__getitem__, pieces(text or ""))), np.int32)


class StreamDecoder:
    """Bytes in, text out; an unfinished character waits for its other bytes."""

    def __init__(self) -> None:
        self.waiting = b""

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data)
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte >= 0xC0:  # a lead byte: complete if as many bytes follow as it announces
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                cut = len(data) - back if need > back else cut
                break
            if byte < 0x80:
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def decode(ids: np.ndarray, tokens: dict[int, bytes], step: int = 4096) -> str:
    stream, out = StreamDecoder(), []
    for at in range(0, len(ids), step):
        out.append(stream.feed(b"".join(map(tokens.__getitem__, ids[at : at + step].tolist()))))
    return "".join([*out, stream.end()])


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", remember: int = PIECES) -> DataFrame:
    """(id, ids, decoded) per row of docs: token ids of the whole text, and the text decoded from these ids again.

    path: a rank file that the driver can read; its content is of fixed size and is sent to the workers. remember: how much
    a worker remembers, memory against time. A null or empty
    text has no tokens and decodes to an empty text. Rows stay as they are, repeated ones and null ids too; no rows give none,
    and other columns aren't read. A very long text is encoded whole; what is remembered of pieces doesn't follow its length.
    """
    with open(path, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        data = content.value
        encoder = kept("bpe", (hash(data), remember), lambda: Encoder(load_ranks(data), remember))
        tokens = encoder.machine.tokens
        gc.disable()  # what is remembered holds no cycles, and would be searched for them again and again
        try:
            for part in sliced(batches):
                ids = [encoder.ids(x) for x in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array([decode(x, tokens) for x in ids], pa.string())], ["id", "ids", "decoded"])
        finally:
            gc.enable()

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).mapInArrow(run, "id bigint, ids array<int>, decoded string")
