"""Byte-level BPE by a lazily determinised transducer, and streaming decoding (operator 10).

**Encoding.** A sequence of tokens is the BPE of a byte string exactly if every
two neighbours are the BPE of their own concatenation. So a nondeterministic
transducer can read the bytes from left to right: it stands at a node of the
trie of all tokens, and where a token ends that fits its predecessor, it may
emit that token and start again at the root. :class:`Transducer` determinises
this machine while it reads: a state is the set of (token before, trie node)
that are still possible; a transition is computed when it is first needed and
then remembered. The BPE of every prefix is unique, so at most one token can
end after a byte, and a transition outputs it. Tokens are emitted once all
possibilities go on from a later border: the lookahead is bounded by the longest
token and ``LOOK_AHEAD``, however long the text is. No merge is ever replayed over a text; merges are applied
only to split single tokens into the two they are made of; by these, pairs of
tokens are tested.

Text is first cut by the tokenizer's pattern. Long texts are cut into slices at
a blank between two non-blanks, where the pattern always starts a new match.
Output of whole short pieces is remembered too, by worker process rather than by task. All remembered
tables have a bound; when one is full, older entries go, which changes no output.

**Decoding.** :class:`Utf8Stream` takes the tokens in chunks of any size. Its state is the
unfinished character at the end (at most three bytes); the transition by a
chunk gives the text that is now complete and the next state.

Defined results: a null or empty text has no tokens and empty output. Special
tokens' strings are ordinary text. Columns beside ``text`` are kept, but for
those named as an output.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from comptoir.llm.common import extended, small_batches

SLICE = 1 << 18  # characters of a text that are cut into pieces at a time
SHORT = 48  # bytes of a piece whose output is remembered
LOOK_AHEAD = 256  # bytes read before tokens are emitted
MOST_PIECES = 200_000  # in each of two generations
MOST_TRANSITIONS = 400_000


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file (base64 and rank in each line). Read through Spark unless it is local."""
    if "://" in path:
        lines = [r.value for r in spark.read.text(path).collect()]  # a vocabulary, of fixed size
    else:
        with open(path, encoding="ascii") as f:
            lines = f.read().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """The merges (those of a rank under ``below``) replayed over ``piece``: applied to single tokens only."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = below, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Bytes in, token ids out. ``encode`` runs it over one piece.

    A state is a tuple of (token before, trie node) possibilities, the oldest first; the one at the
    root, if any, has just ended a token. ``moves[state << 8 | byte]`` is (token that ends here or -1, next state).
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}  # trie: node * 256 + byte -> node
        self.token_at, self.depth = [-1], [0]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                to = self.child.get(node << 8 | b)
                if to is None:
                    to = self.child[node << 8 | b] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                    self.token_at.append(-1)
                node = to
            self.token_at[node] = rank
        self.inner = {k >> 8 for k in self.child}  # nodes from which a token can go on
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states and transitions. State 0 is the start."""
        self.states = [((-1, 0),)]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def state_of(self, key: tuple) -> int:
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        return to

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts of the merge that makes a token; None if the merges never make it."""
        if token not in self.halves:
            parts = merge_bytes(token, self.ranks, self.ranks[token])
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether token b can stand after token a (-1: at the start)."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= MOST_TRANSITIONS:
                self.pairs.clear()
            y = self.bytes_of[b]
            ok = len(y) == 1 or self.split(y) is not None
            if ok and a >= 0:
                ok = self._apart(self.bytes_of[a], y)
            self.pairs[a, b] = ok
        return ok

    def _apart(self, x: bytes, y: bytes) -> bool:
        """Whether the merges that make tokens x and y leave them apart.

        Goes back in time over the parts that meet at the border. A part made by a merge of rank r
        is there until a merge of a later rank takes it in (``x_end``, ``y_end``). If two parts that
        meet could merge before either is taken in, tokens x and y don't come about side by side.
        On equal ranks the merge further left comes first.
        """
        ranks, never = self.ranks, len(self.ranks) + 256
        x_end = y_end = never
        while True:
            r = ranks.get(x + y)
            if r is not None and r < x_end and r <= y_end:
                return False
            x_made = ranks[x] if len(x) > 1 else -1
            y_made = ranks[y] if len(y) > 1 else -1
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                x, x_end = self.split(x)[1], x_made
            else:
                y, y_end = self.split(y)[0], y_made

    def _next(self, state: int, byte: int) -> tuple[int, int]:
        """Determinise one transition."""
        child, token_at, inner, ending, live = self.child, self.token_at, self.inner, [], []
        for before, node in self.states[state]:
            to = child.get(node << 8 | byte)
            if to is not None:
                t = token_at[to]
                if t >= 0:
                    ending.append((before, t))
                if to in inner:
                    live.append((before, to))
        # The BPE of what was read is unique and exists, so just one of these tokens ends it: the last one needs no test.
        last = len(ending) - 1
        ends = next((t for i, (before, t) in enumerate(ending) if i == last or self.fits(before, t)), -1)
        if ends >= 0:
            live.append((ends, 0))
        move = self.moves[state << 8 | byte] = ends, self.state_of(tuple(live))
        return move

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        ended: list[int] = []  # the token that ends after each byte since the last one emitted
        state = 0
        for at in range(0, len(piece), LOOK_AHEAD):
            if len(self.moves) >= MOST_TRANSITIONS:
                held = self.states[state]
                self.reset()
                state = self.state_of(held)
            known, learn = self.moves.get, self._next
            for byte in piece[at:at + LOOK_AHEAD]:
                end, state = known(state << 8 | byte) or learn(state, byte)
                ended.append(end)
            if at + LOOK_AHEAD < len(piece):
                final = self._settled(ended, self.states[state])
                out += self._path(ended[:final])
                del ended[:final]
        return out + self._path(ended)

    def _settled(self, ended: list[int], live: tuple) -> int:
        """The last border that the paths of all possibilities have in common."""
        borders = {len(ended) - self.depth[node] for _, node in live}
        while len(borders) > 1:
            last = max(borders)
            borders.remove(last)
            borders.add(last - len(self.bytes_of[ended[last - 1]]))
        return borders.pop() if borders else 0

    def _path(self, ended: list[int]) -> list[int]:
        """The tokens that lead to the end, from the token that ends at each place."""
        out, at = [], len(ended)
        while at > 0:
            t = ended[at - 1]
            if t < 0:
                raise ValueError("the vocabulary lacks a byte of the text")
            out.append(t)
            at -= len(self.bytes_of[t])
        return out[::-1]


def slices(text: str) -> Iterator[str]:
    """The text in slices, cut before a blank that stands between two non-blanks."""
    at, n = 0, len(text)
    while n - at > SLICE:
        cut = text.find(" ", at + SLICE)
        while cut > 0 and (text[cut - 1].isspace() or cut + 1 >= n or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class Pieces(dict):
    """Token ids by piece. Short pieces are remembered, in two generations of bounded size."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine, self.older = machine, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = tuple(self.machine.encode(piece.encode()))
        if len(piece) <= SHORT:
            if len(self) >= MOST_PIECES:
                self.older = dict(self)  # for pieces that come back
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Texts to token ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.machine = Transducer(ranks)
        self.known = Pieces(self.machine)
        self.decimal = {i: str(i) for i in ranks.values()}.__getitem__

    def ids(self, text: str) -> Iterator[list[int]]:
        """Token ids, slice by slice."""
        known = self.known.__getitem__
        for part in slices(text):
            yield list(chain.from_iterable(map(known, self.find(part))))


class Utf8Stream:
    """Token ids to text, chunk by chunk. ``state`` holds the bytes of an unfinished character."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.get = bytes_of.__getitem__
        self.state = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end of ``data`` begin a character that is not complete."""
        for back in range(1, min(4, len(data) + 1)):
            b = data[-back]
            if b & 0xC0 != 0x80:  # not a continuation byte
                need = 1 if b < 0x80 else 2 if b & 0xE0 == 0xC0 else 3 if b & 0xF0 == 0xE0 else 4
                return back if need > back else 0
        return 0

    def feed(self, ids) -> str:
        """The text completed by these tokens."""
        data = self.state + b"".join(map(self.get, ids))
        done = len(data) - self.unfinished(data)
        self.state = data[done:]
        return data[:done].decode("utf-8", "replace")

    def end(self) -> str:
        """What is left of an unfinished character, and back to the start."""
        left, self.state = self.state.decode("utf-8", "replace"), b""
        return left


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, ``with_ids``, ``token_ids`` (array<int>).

    Map-only: no shuffle. The vocabulary (fixed size) is broadcast. Hashes are
    fed slice by slice, so a long text is never held as ids unless they are asked for.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # A worker process keeps a broadcast's value from task to task, and with it what it has remembered.
    sent = spark.sparkContext.broadcast({"ranks": read_ranks(spark, ranks_path), "encoder": None})

    def work(batches):
        held = sent.value
        encoder = held["encoder"] = held["encoder"] or Encoder(held["ranks"], pattern)
        stream = Utf8Stream(encoder.machine.bytes_of)
        for texts, in batches:
            counts, id_hashes, text_hashes, ends, all_ids = [], [], [], [0], array("i")
            for text in texts.to_pylist():
                n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
                for ids in encoder.ids(text or ""):
                    if ids:
                        ids_sha.update(("," * (n > 0) + ",".join(map(encoder.decimal, ids))).encode())
                        n += len(ids)
                    text_sha.update(stream.feed(ids).encode())
                    if with_ids:
                        all_ids.extend(ids)
                text_sha.update(stream.end().encode())
                counts.append(n)
                id_hashes.append(ids_sha.hexdigest())
                text_hashes.append(text_sha.hexdigest())
                ends.append(len(all_ids))
            out = [pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(all_ids, np.int32))))
            yield None, out

    return extended(docs, [docs["text"]], "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                    + ", token_ids array<int>" * with_ids, work)
