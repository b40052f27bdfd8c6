"""BPE encoding and decoding with an automaton over tokens.

*Compiling.*  The automaton starts as one state with an arc to itself for each
base symbol: every sequence of symbols is accepted.  Each merge (u, v) is then
applied in order as a gadget on the automaton: arcs labelled u are led to a
copy of their target that has lost its v arc, and where u and then v could be
followed a new arc uv takes their place.  All arcs with one label lead to one
state, so the state after token a is named by a, and the automaton needs no
more than the merge at which an arc (a, b) was taken away; whether (a, b) is
an arc follows by undoing the gadgets that made a and b (``arc``).  A sequence
of tokens is accepted exactly if it is the BPE tokenization of its text.

*Encoding.*  The automaton is run over the symbols of a pre-split word.  A
deterministic state holds the open arcs: label prefixes read so far, each with
the token it starts after; exactly one arc closes at each symbol, which gives
the last token of the prefix.  States and transitions are entered into a table
when first met, so known stretches of text cost one lookup a symbol; the tokens
of a word are read backwards from its states.

*Decoding* emits the labels of the arcs.

Words are split as the vocabulary file's normalizer and pre-tokenizer say.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame

from . import common

#: Tables are emptied beyond these sizes (nothing but speed depends on them).
MOST_STATES, MOST_RUNS = 1 << 18, 1 << 19
#: Longer words (bytes) are encoded one at a time.
LONG_WORD = 64
#: Long texts are split into words in pieces of about so many characters, at white space.
PIECE = 1 << 20
#: Characters that NFC leaves alone and that lower-case one by one; others take the library's normalizer.
_ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")
_SPACE = re.compile("[ \t\n\r]")


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str = ""):
        self.size = max(vocab.values()) + 1
        self.label = [""] * self.size
        for text, i in vocab.items():
            self.label[i] = text
        self.symbol = {b: vocab[c] for c, b in _byte_chars().items()}
        self.final_symbol = {b: vocab[c + word_end] for c, b in _byte_chars().items()}
        self._compile(vocab, merges)
        self._spell()
        self._clear()

    # compiling

    def _compile(self, vocab, merges) -> None:
        self.born = [-1] * self.size
        self.left, self.right = [-1] * self.size, [-1] * self.size
        self.gone: dict[int, int] = {}
        self.accepted = {*self.symbol.values(), *self.final_symbol.values()}
        for rank, (u, v) in enumerate(merges):
            a, b, made = vocab[u], vocab[v], vocab[u + v]
            if self.born[made] >= 0:
                raise ValueError(f"two merges make {u + v!r}")
            if not self.arc(a, b):  # unreachable: the gadget changes nothing
                continue
            self.gone[a * self.size + b] = rank
            self.born[made], self.left[made], self.right[made] = rank, a, b
            self.accepted.add(made)

    def arc(self, a: int, b: int) -> bool:
        """Whether token b may follow token a (-1: the start of a word)."""
        if b not in self.accepted:
            return False
        if a < 0:
            return True
        if a not in self.accepted:
            return False
        size, gone, born = self.size, self.gone, self.born
        if a * size + b in gone:
            return False
        while True:
            if born[a] > born[b]:  # the state after a was that after its right part when a was made
                made, a = born[a], self.right[a]
                if gone.get(a * size + b, made) < made:
                    return False
            elif born[b] >= 0:  # the arc b was made where its left part could be followed
                made, b = born[b], self.left[b]
                if gone.get(a * size + b, made + 1) <= made:
                    return False
            else:
                return True

    # encoding

    def _spell(self) -> None:
        self.child: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        spelled: dict[int, tuple[int, ...]] = {}
        self.length = [0] * self.size
        for t in sorted(self.accepted, key=lambda t: self.born[t]):
            s = spelled[t] = (t,) if self.born[t] < 0 else spelled[self.left[t]] + spelled[self.right[t]]
            self.length[t] = len(s)
            node = 0
            for symbol in s:
                key = node * self.size + symbol
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = self.child[key]
            self.token[node] = t

    def _clear(self) -> None:
        start = (0, -1)  # of each open arc: how far its label is read, and the token it starts after
        self.states, self.open = {start: 0}, [start]
        self.arcs: dict[int, bool] = {}
        self.closed = np.full(1 << 12, -1, np.int32)
        self.kind = np.full(256, -1, np.int64)  # columns of the tables, in the order in which bytes are met
        self.kinds: list[int] = []
        self.next = np.full((1 << 12, 32), -1, np.int32)  # state and byte to state
        self.end = np.full((1 << 12, 32), -1, np.int32)  # state and last byte to token
        self.lengths = np.array(self.length, np.int64)

    def _may(self, a: int, b: int) -> bool:
        key = (a + 1) * self.size + b
        found = self.arcs.get(key)
        if found is None:
            found = self.arcs[key] = self.arc(a, b)
        return found

    def _column(self, byte: int) -> int:
        if self.kind[byte] < 0:
            self.kind[byte] = len(self.kinds)
            self.kinds.append(byte)
            if len(self.kinds) > self.next.shape[1]:
                self.next, self.end = (np.concatenate([t, np.full_like(t, -1)], axis=1) for t in (self.next, self.end))
        return int(self.kind[byte])

    def _enter(self, state: int, byte: int) -> int:
        """The state after one more symbol, entered into the table."""
        symbol, still, closed = self.symbol[byte], [], -1
        arcs = iter(self.open[state])
        for node, after in zip(arcs, arcs):
            node = self.child.get(node * self.size + symbol)
            if node is None:
                continue
            t = self.token[node]
            if t >= 0 and closed < 0 and self._may(after, t):
                closed = t
            if self.inner[node]:
                still += (node, after)
        still = (*still, 0, closed)
        to = self.states.get(still)
        if to is None:
            to = self.states[still] = len(self.open)
            self.open.append(still)
            if to >= len(self.closed):
                self.closed, self.next, self.end = (np.concatenate([t, np.full_like(t[:len(t) // 4], -1)]) for t in (self.closed, self.next, self.end))
            self.closed[to] = closed
        self.next[state, self._column(byte)] = to
        return to

    def _finish(self, state: int, byte: int) -> int:
        """The last token of a word that ends with this byte, entered into the table."""
        symbol = self.final_symbol[byte]
        arcs = iter(self.open[state])
        for node, after in zip(arcs, arcs):
            node = self.child.get(node * self.size + symbol)
            if node is not None and (t := self.token[node]) >= 0 and self._may(after, t):
                self.end[state, self._column(byte)] = t
                return t
        raise AssertionError("no arc closes")

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word."""
        if not word:
            return []
        state, path = 0, [0]
        for byte in word[:-1]:
            to = int(self.next[state, self._column(byte)])
            state = self._enter(state, byte) if to < 0 else to
            path.append(state)
        t = int(self.end[state, self._column(word[-1])])
        if t < 0:
            t = self._finish(state, word[-1])
        found, at = [t], len(word) - self.length[t]
        while at > 0:
            t = int(self.closed[path[at]])
            found.append(t)
            at -= self.length[t]
        return found[::-1]

    def _step(self, table: str, state: np.ndarray, byte: np.ndarray, add) -> np.ndarray:
        """A table's entries for many states and bytes at once; missing ones are worked out first."""
        for b in np.unique(byte[self.kind[byte] < 0]):
            self._column(int(b))
        column = self.kind[byte]
        found = getattr(self, table)[state, column]
        if (found < 0).any():
            lost = found < 0
            for pair in np.unique(state[lost].astype(np.int64) << 8 | byte[lost]).tolist():
                add(pair >> 8, pair & 255)
            found = getattr(self, table)[state, column]
        return found

    def encode_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of many words that aren't empty, in a row, and where each word's end; all words go forward in step."""
        if len(self.open) > MOST_STATES or len(self.arcs) > 4 * MOST_STATES:
            self._clear()
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        text = np.frombuffer(b"".join(words), np.uint8)
        begin, size = (np.cumsum(size) - size)[order], size[order]
        most = int(size[0])
        more = np.searchsorted(-size, -np.arange(1, most + 1), side="left")  # words that go on after t + 1 bytes
        first = np.cumsum(more) - more  # of the states after t + 1 bytes
        path = np.empty(int(more.sum()), np.int32)
        last = np.empty(len(words), np.int32)
        state = np.zeros(len(words), np.int32)
        for t in range(most):
            byte = text[begin[:len(state)] + t]
            n = int(more[t])
            last[n:len(state)] = self._step("end", state[n:], byte[n:], self._finish)
            state = self._step("next", state[:n], byte[:n], self._enter)
            path[first[t]:first[t] + n] = state
        tokens, owners = [last], [np.arange(len(words))]
        at = size - self.lengths[last]
        owner = np.flatnonzero(at > 0)
        while len(owner):
            t = self.closed[path[first[at[owner] - 1] + owner]]
            tokens.append(t)
            owners.append(owner)
            at[owner] -= self.lengths[t]
            owner = owner[at[owner] > 0]
        count = np.bincount(np.concatenate(owners), minlength=len(words))
        by_word = np.empty(len(words), np.int64)
        by_word[order] = count
        ends = np.cumsum(by_word)
        out = np.empty(int(ends[-1]), np.int32)
        final = ends[order]
        for k, (t, o) in enumerate(zip(tokens, owners)):
            out[final[o] - 1 - k] = t
        return out, ends


class Tokenizer:
    """A vocabulary file's splitting rules with its compiled automaton."""

    def __init__(self, text: str):
        import tokenizers

        spec = json.loads(text)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.labels = self.automaton.label + [""] * (max([0, *self.special.values()]) + 1 - self.automaton.size)
        for content, i in self.special.items():
            self.labels[i] = content
        self.apart = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        library = tokenizers.Tokenizer.from_str(text)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.bytes_of = _byte_chars()
        rules = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(rules[0]["pattern"]["Regex"])

    def pieces(self, text: str) -> Iterator[str | list[bytes | int]]:
        """A text in pieces: lower-cased where that is all, else the bytes of split words and the ids of special tokens."""
        at = 0
        while at < len(text):
            cut = _SPACE.search(text, at + PIECE) if len(text) - at > PIECE else None
            to = cut.start() if cut else len(text)
            piece = text[at:to]
            special = self.apart is not None and "<" in piece and self.apart.search(piece)
            if not special and not _ODD.search(piece):
                yield piece.lower()
            else:
                parts = self.apart.split(piece) if special else [piece]
                yield [w for k, part in enumerate(parts) for w in ([self.special[part]] if k % 2 else self._split(part))]
            at = to

    def _split(self, part: str) -> list[bytes]:
        """Words as the library's normalizer and pre-tokenizer give them."""
        return [bytes(map(self.bytes_of.__getitem__, w)) for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))]

    def ids_of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words in a row, and where each word's end; very long words, which would hold up the others, on their own."""
        ids, ends = self.automaton.encode_many([w if len(w) <= LONG_WORD else w[:1] for w in words])
        long = [n for n, w in enumerate(words) if len(w) > LONG_WORD]
        if long:
            found = np.split(ids, ends[:-1])
            for n in long:
                found[n] = np.array(self.automaton.encode(words[n]), np.int32)
            ids, ends = np.concatenate(found), np.cumsum([len(f) for f in found])
        return ids, ends

    def ids_of_runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for lower-cased runs between white space."""
        letters, find = str.isalpha, self.pattern.findall
        # letters alone, or letters and one comma or full stop, need no pattern
        parts = [(r,) if letters(r) else (r[:-1], r[-1]) if r[-1:] in (",", ".") and letters(r[:-1]) else find(r) for r in runs]
        words = [w.encode() for p in parts for w in p]
        if not words:
            return np.empty(0, np.int32), np.zeros(len(runs), np.int64)
        ids, ends = self.ids_of_words(words)
        return ids, np.r_[0, ends][np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))]

    def decode(self, ids) -> str:
        """The labels of the arcs, joined as the library does for files without a decoder."""
        return " ".join([self.labels[i] for i in ids])


class Encoder:
    """Encodes texts by the runs between their white space; the ids of runs met lately are kept."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int32)

    def _slots(self, runs: list[str]) -> np.ndarray:
        if len(self.slot) > MOST_RUNS:
            self._clear()
        known = self.slot.get
        slots = [known(r, -1) for r in runs]
        found = np.array(slots, np.int32)
        lost = np.flatnonzero(found < 0)
        if len(lost):
            new = [runs[i] for i in lost.tolist()]
            ids, ends = self.tokenizer.ids_of_runs(new)
            first = len(self.ends) - 1
            found[lost] = np.arange(first, first + len(new))
            self.slot.update(zip(new, range(first, first + len(new))))
            self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, (ends + self.ends[-1]).astype(np.int32)])
        return found

    def _plain(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of lower-cased pieces."""
        split = pa.compute.ascii_split_whitespace(pa.array(pieces, pa.string()))
        coded = split.flatten().dictionary_encode()
        slot = self._slots(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        kept = pa.ListArray.from_arrays(pa.array(self.ends), pa.array(self.ids))
        taken = kept.take(pa.array(slot))
        out, at = taken.values.to_numpy(), taken.offsets.to_numpy()[split.offsets.to_numpy()]
        return [out[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def _odd(self, words: list[bytes | int]) -> np.ndarray:
        bytes_only = [w for w in words if not isinstance(w, int)]
        found = iter(())
        if bytes_only:
            ids, ends = self.tokenizer.ids_of_words(bytes_only)
            found = iter(np.split(ids, ends[:-1]))
        return np.concatenate([np.array([w], np.int32) if isinstance(w, int) else next(found) for w in words] or [np.empty(0, np.int32)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        plain: list[tuple[int, int, str]] = []
        held = 0

        def work():
            for (n, k, _), ids in zip(plain, self._plain([p for _, _, p in plain])):
                found[n][k] = ids
            plain.clear()

        for n, text in enumerate(texts):
            for k, piece in enumerate(self.tokenizer.pieces(text)):
                found[n].append(self._odd(piece) if isinstance(piece, list) else np.empty(0, np.int32))
                if isinstance(piece, str):
                    plain.append((n, k, piece))
                    held += len(piece)
                    if held > 4 * PIECE:
                        work()
                        held = 0
        if plain:
            work()
        return [f[0] if len(f) == 1 else np.concatenate(f or [np.empty(0, np.int32)]) for f in found]


@functools.lru_cache(maxsize=2)
def tokenizer(text: str) -> Tokenizer:
    """Compiled once in each Python worker."""
    return Tokenizer(text)


@functools.lru_cache(maxsize=2)
def encoder(text: str) -> Encoder:
    return Encoder(tokenizer(text))


def vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row; a NULL text counts as empty and has no ids."""
    text = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # bounded by the vocabulary

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            ids = encoder(text.value).encode([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return common.narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); NULL ids give an empty text."""
    text = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(text.value)
        for batch in batches:
            for small in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                texts = [known.decode(ids or []) for ids in small.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([small.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return common.narrow(encoded, doc_id="long", ids="array<int>").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 and decoded_sha256 (of the decimal ids and of the decoded text).

    Encodes and decodes in one pass over each whole text; a NULL text counts
    as empty (no tokens, digests of the empty string).  Repeated rows all come
    back, an empty table gives an empty result, other columns are ignored.
    """
    text = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def digest(ids: list[int], names: list[str]) -> str:
        found = hashlib.sha256()
        for at in range(0, len(ids), PIECE):
            found.update((" " * (at > 0) + " ".join([names[i] for i in ids[at:at + PIECE]])).encode())
        return found.hexdigest()

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(text.value)
        labels = known.tokenizer.labels
        numbers = list(map(str, range(len(labels))))
        for batch in common.slices(batches, "text"):
            found = map(np.ndarray.tolist, known.encode([t or "" for t in batch.column(1).to_pylist()]))
            rows = [(len(ids), digest(ids, numbers), digest(ids, labels)) for ids in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.string()) for i in (1, 2))],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
