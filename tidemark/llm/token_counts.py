"""Token counts of whole texts by a compiled finite-state transducer.

For the word-level BPE of a tokenizers file: texts are normalised and cut into
words, and each word's merges run over its bytes, the last of which bears the
end-of-word mark.  The merges of a word need no merging here.  A run of tokens
is what BPE gives exactly if each two neighbours are what BPE gives for the two
alone; so of all tokens that end at a byte, just one fits what came before it, and
the last token at each of the last few bytes is all that the future can depend
on.  That is a deterministic transducer: its state is the longest suffix of the
word that starts a token, with the last token and the relative count at each
byte of it; a transition carries the change in the count of emitted tokens.  The
last byte of a word leads back to the start state, from wherever.  States are
compiled when first met and kept in dense tables, up to ``STATES``; then the
tables start afresh with the states in use.

The bytes of many texts form one stream, cut into chunks of equal length, and
numpy steps through all chunks at once.  A chunk's state map is constant from its
first end of a word on; the bytes before that, its head, are the part that depends
on the state it is entered in.  A first pass gives all constant parts.  The map of a
head is then tabulated at the states that can reach it, once for chunks of the same
bytes: chunks that are all head, in the midst of a long word, are first entered in a
guess, the state that their predecessor leaves in when it begins a word; and while some
map leaves in a state at which a following one isn't tabulated, all such entries are
walked at once.  A state is what the last few bytes allow, so the maps close after a few
such steps, however long the word is.  A parallel prefix scan then composes them by doubling: after k steps an
entry knows where it leads and how many tokens it emits over the next 2^k chunks.

Defined results:

* null or empty text, or one of white space: 0 tokens;
* the strings of special tokens inside a text count one token each, as by the
  library's default;
* rows are independent: repeated ids and rows just repeat;
* texts of any length go through in slices of ``SLICE`` characters, cut before what the
  library takes for white space, so never within a word; without any, a text stays whole;
* an empty table gives an empty table; other columns stay out of the result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from .common import small_batches

#: Characters handled at once, symbols of a chunk, states kept, answers kept on pairs of tokens.
SLICE, CHUNK, STATES, MEMO = 1 << 20, 128, 200_000, 300_000
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
#: Lower case that Python's str.lower lacks or, for sigma, takes from the context.
_LOWER = {0x03A3: 0x03C3, 0xA7CB: 0x0264, 0xA7DC: 0x019B}


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


def _classes() -> np.ndarray:
    """Class of every code point by the tables of the library that runs the split pattern."""
    points = np.array([*range(0xD800), *range(0xE000, 0x110000)], np.uint32)
    every = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_SPACE, r"\s+")):
        for _, (start, end) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every):
            out[points[start:end]] = kind
    return out


class Transducer:
    """Counts the tokens of words; compiled from a vocabulary and its merges as needed.

    A word is a string with one character below 256 for each byte; a token that
    ends a word has ``END`` after its bytes.
    """

    END = "\u0100"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        model = spec["model"]
        plain = str.maketrans({c: chr(b) for b, c in enumerate(_byte_names())})
        mark = model["end_of_word_suffix"]
        own = lambda name: name[: -len(mark)].translate(plain) + self.END if name.endswith(mark) else name.translate(plain)
        self.tokens = {t: t for t in map(own, model["vocab"])}
        self.merge_rank: dict[tuple[str, str], int] = {}
        for i, (a, b) in enumerate(model["merges"]):
            self.merge_rank.setdefault((own(a), own(b)), i)
        inner = {t.removesuffix(self.END) for t in self.tokens}
        self.heads = {t[:k] for t in inner for k in range(len(t))} | {t for t in self.tokens if t[-1] != self.END}
        self.longest = max(map(len, inner))
        self.small = np.int8 if self.longest < 120 else np.int16
        self.unknown = np.iinfo(self.small).min
        self.fits_memo: dict[tuple, bool] = {}
        self.clear()

    # -- compilation -------------------------------------------------------------

    def clear(self) -> None:
        self.columns = np.full(256, -1, np.int64)
        self.n_columns = 0
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next = np.full((1024, 32), -1, np.int32)
        self.change = np.full((1024, 32), self.unknown, self.small)
        self.last = np.full((1024, 32), self.unknown, self.small)
        self.start = self._state(("", (None,), (0,)))

    def _grow(self, rows: int, columns: int) -> None:
        for name in ("next", "change", "last"):
            old = getattr(self, name)
            new = np.full((rows, columns), -1 if name == "next" else self.unknown, old.dtype)
            new[: old.shape[0], : old.shape[1]] = old
            setattr(self, name, new)

    def _state(self, key: tuple) -> int:
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            if len(self.states) > len(self.next):
                self._grow(len(self.next) * 3 // 2, self.next.shape[1])
        return self.ids[key]

    def column(self, byte: int) -> int:
        if self.columns[byte] < 0:
            self.columns[byte] = self.n_columns
            self.n_columns += 1
            if self.n_columns > self.next.shape[1]:
                self._grow(len(self.next), self.next.shape[1] + 16)
        return int(self.columns[byte])

    def merged(self, word: str) -> list[str]:
        """BPE by the book, for the few symbols of two tokens."""
        parts = list(word)
        if parts[-1] == self.END:
            parts[-2:] = [parts[-2] + self.END]
        while True:
            ranks = [self.merge_rank.get(p) for p in zip(parts, parts[1:], strict=False)]
            found = [r for r in ranks if r is not None]
            if not found:
                return parts
            at = ranks.index(min(found))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, before: str | None, token: str) -> bool:
        """Whether ``token`` is what BPE puts after ``before``, None being the start of a word."""
        key = (before, token)
        if key not in self.fits_memo:
            if len(self.fits_memo) >= MEMO:
                self.fits_memo.clear()
            self.fits_memo[key] = self.merged(token) == [token] if before is None else self.merged(before + token) == [before, token]
        return self.fits_memo[key]

    def _step(self, state: int, symbol: str) -> tuple[str, tuple, tuple, int]:
        """Suffix, last tokens and counts after a symbol, and the change in the count."""
        suffix, lasts, counts = self.states[state]
        grown = suffix + symbol
        for k in range(len(lasts)):
            token = self.tokens.get(grown[k:])
            if token is not None and self._fits(lasts[k], token):
                return grown, (*lasts, token), (*counts, counts[k] + 1), counts[k] + 1 - counts[-1]
        raise AssertionError("every byte is a token, so one always fits")

    def compile(self, state: int, byte: int) -> None:
        """Fill in one inner transition."""
        grown, lasts, counts, change = self._step(state, chr(byte))
        k = 0
        while grown[k:] not in self.heads:
            k += 1
        to = self._state((grown[k:], lasts[k:], tuple(c - counts[-1] for c in counts[k:])))
        self.next[state, self.columns[byte]], self.change[state, self.columns[byte]] = to, change

    def compile_last(self, state: int, byte: int) -> None:
        """Fill in the transition of a word's last byte."""
        self.last[state, self.columns[byte]] = self._step(state, chr(byte) + self.END)[3]

    # -- running -----------------------------------------------------------------

    def _missing(self, table: np.ndarray, state: np.ndarray, byte: np.ndarray, gap, fill) -> None:
        cells = table[state, self.columns[byte]]
        lack = cells == gap
        if lack.any():
            for cell in np.unique(state[lack].astype(np.int64) << 8 | byte[lack]).tolist():
                fill(cell >> 8, cell & 255)

    def _walk(self, symbols: np.ndarray, ends: np.ndarray, runs: np.ndarray, state: np.ndarray, out: np.ndarray, at: np.ndarray, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Step all lanes through their columns where ``runs``; out[at] gets a word's count at its end.

        Returns the lanes' states and counts since then.  ``held`` are arrays of other
        states in use; they are kept up to date, in place, if the tables start afresh.
        """
        count = np.zeros(len(state), np.int64)
        for j in range(symbols.shape[0]):
            go = np.flatnonzero(runs[j])
            if not len(go):
                continue
            if len(self.states) > STATES:
                self._afresh([state, *held])
            byte, now, end = symbols[j, go], state[go], ends[j, go]
            mid, fin = ~end, end
            if mid.any():
                self._missing(self.next, now[mid], byte[mid], -1, self.compile)
                cell = self.columns[byte[mid]]
                state[go[mid]] = self.next[now[mid], cell]
                count[go[mid]] += self.change[now[mid], cell]
            if fin.any():
                lanes = go[fin]
                self._missing(self.last, now[fin], byte[fin], self.unknown, self.compile_last)
                out[at[j, lanes]] = count[lanes] + self.last[now[fin], self.columns[byte[fin]]]
                state[lanes], count[lanes] = self.start, 0
        return state, count

    def _afresh(self, held: list[np.ndarray]) -> None:
        """Empty tables; the states in ``held`` are compiled into them again."""
        used = np.unique(np.concatenate(held))
        keys = [self.states[s] for s in used.tolist()]
        bytes_ = np.flatnonzero(self.columns >= 0)
        self.clear()
        for b in bytes_.tolist():
            self.column(b)
        moved = np.array([self._state(k) for k in keys], np.int64)
        for states in held:
            states[:] = moved[np.searchsorted(used, states)]

    def count_words(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word of a byte stream; ``ends`` marks the last byte of each word."""
        n, n_words = len(symbols), int(ends.sum())
        out = np.zeros(n_words, np.int64)
        if not n:
            return out
        for b in np.flatnonzero(np.bincount(symbols, minlength=256)).tolist():
            self.column(b)
        word = np.cumsum(ends) - ends  # the word a byte is part of
        lanes = -(-n // CHUNK)
        fold = lambda x, fill: np.concatenate([x, np.full(lanes * CHUNK - n, fill, x.dtype)]).reshape(lanes, CHUNK).T.copy()
        symbols, ends, word, real = fold(symbols, 0), fold(ends, False), fold(word, 0), fold(np.ones(n, bool), False)
        past = np.cumsum(ends, axis=0) - ends > 0  # beyond the chunk's first end of a word
        head, through = real & ~past, ~ends.any(axis=0)  # the last chunk has an end, so all that are all head have a next one
        # the constant part of every chunk's map
        leave, since = self._walk(symbols, ends, real & past, np.full(lanes, self.start, np.int64), out, word, [])
        after_known = np.concatenate([[True], ~through[:-1]])
        known = np.flatnonzero(after_known)  # chunks whose entry state is known
        enter = np.concatenate([[self.start], leave[:-1]])[known]
        before = np.concatenate([[0], since[:-1]])[known]
        like = np.arange(lanes)  # the first chunk with the same bytes: one map for all of them
        to = np.flatnonzero(through)
        if len(to):
            _, first, same = np.unique(symbols[:, to], axis=1, return_index=True, return_inverse=True)
            like[to] = to[first[same.ravel()]]
        follows = np.unique(np.stack([like[to], like[to + 1]]), axis=1)
        kind, entry, exit_, emitted = self._tabulate(symbols, ends, head, through, follows, like[known], enter)
        # each chunk with the rows of its kind
        order = np.argsort(kind, kind="stable")
        low, high = (np.searchsorted(kind, like, side, sorter=order) for side in ("left", "right"))
        chunk = np.repeat(np.arange(lanes), high - low)
        row = order[np.arange(len(chunk)) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)]
        entry, exit_, emitted = entry[row], exit_[row], emitted[row]
        # the scan: each entry of the tables jumps over its chunk, then over two, four, ... of them
        place = self._found(chunk, entry, known, enter)
        jump = np.arange(len(chunk))
        open_ = through[chunk]
        jump[open_] = self._found(chunk, entry, chunk[open_] + 1, exit_[open_])
        total = np.where(open_, emitted, 0)
        while (further := jump[jump]).tolist() != jump.tolist():
            total, jump = total + total[jump], further
        out[word[0, known]] = before + total[place] + emitted[jump[place]]
        return out

    @staticmethod
    def _found(chunk: np.ndarray, entry: np.ndarray, want_chunk: np.ndarray, want_entry: np.ndarray) -> np.ndarray:
        """Where (chunk, entry) pairs stand in the tables; -1 where they don't."""
        keys, want = chunk.astype(np.int64) << 32 | entry, want_chunk.astype(np.int64) << 32 | want_entry
        order = np.argsort(keys)
        at = np.minimum(np.searchsorted(keys, want, sorter=order), len(keys) - 1)
        return np.where(keys[order[at]] == want, order[at], -1) if len(keys) else np.full(len(want), -1)

    def _tabulate(self, symbols: np.ndarray, ends: np.ndarray, head: np.ndarray, through: np.ndarray, follows: np.ndarray, known: np.ndarray, enter: np.ndarray) -> tuple[np.ndarray, ...]:
        """The heads' maps at all states that reach them: (chunk, entry, exit, emitted) rows.

        Chunks stand for all with the same bytes; ``follows`` has which comes after which.
        ``enter``, the states known to reach ``known`` chunks, is kept up to date.
        """
        chunk = entry = exit_ = emitted = np.empty(0, np.int64)
        before, after = follows
        guess = np.full(len(before), self.start, np.int64)
        if len(before):
            guess, _ = self._walk(symbols[:, before], ends[:, before], head[:, before], guess, np.empty(0, np.int64), symbols[:, before], [enter])
        new_chunk, new_entry = np.concatenate([known, after]), np.concatenate([enter, guess])
        while True:
            pairs = np.unique(np.stack([new_chunk, new_entry]), axis=1)
            lack = self._found(chunk, entry, *pairs) < 0
            new_chunk, new_entry = pairs[0, lack], pairs[1, lack].copy()
            if not len(new_chunk):
                return chunk, entry, exit_, emitted
            last = np.full(len(new_chunk), -1, np.int64)
            lane = np.broadcast_to(np.arange(len(new_chunk)), (len(symbols), len(new_chunk)))
            cut = (x[:, new_chunk] for x in (symbols, ends, head))
            left, count = self._walk(*cut, new_entry.copy(), last, lane, [new_entry, entry, exit_, enter])
            chunk, entry = np.concatenate([chunk, new_chunk]), np.concatenate([entry, new_entry])
            exit_, emitted = np.concatenate([exit_, left]), np.concatenate([emitted, np.where(through[new_chunk], count, last)])
            low, high = np.searchsorted(before, new_chunk, "left"), np.searchsorted(before, new_chunk, "right")
            next_ = np.arange((high - low).sum()) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)
            new_chunk, new_entry = after[next_], np.repeat(left, high - low)


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, path: str):
        self.transducer = Transducer(path)
        self.classes = _classes()
        self.special = re.compile("|".join(map(re.escape, self.transducer.special)) or "(?!)")
        self.space = re.compile(f"[{re.escape(''.join(map(chr, np.flatnonzero(self.classes == _SPACE).tolist())))}]")

    @staticmethod
    def normalised(text: str) -> str:
        """NFC, then lower case by single characters; white space needs no change to be dropped."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            for upper, lower in _LOWER.items():
                text = text.replace(chr(upper), chr(lower))
        return text.lower()

    def _word_starts(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which characters start a word, and which belong to one."""
        cls = self.classes[points]
        inside = cls != _SPACE
        before = np.concatenate([[_SPACE], cls[:-1]])
        starts = inside & ((cls != before) | (cls == _DIGIT))
        n = len(points)
        quotes = np.flatnonzero((points == 39) & (before != _OTHER))
        if len(quotes):
            padded = np.concatenate([points, np.zeros(2, points.dtype)])
            one, two = padded[quotes + 1], padded[quotes + 2]
            short = np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
            long_ = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for which, size in ((quotes[short], 2), (quotes[long_ & ~short], 3)):
                for k in range(1, size):
                    starts[which + k] = False
                after = which[which + size < n] + size
                starts[after] = inside[after]
        return starts, inside

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        total = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        size = 0
        for i, text in enumerate(texts):
            for piece in self._pieces(text):
                if piece is None:
                    total[i] += 1
                    continue
                parts.append(piece)
                owner.append(i)
                size += len(piece)
                if size >= SLICE:
                    self._add(parts, owner, total)
                    parts, owner, size = [], [], 0
        self._add(parts, owner, total)
        return total

    def _pieces(self, text: str) -> Iterator[str | None]:
        """Normalised slices of a text, and None for each special token in it."""
        at = 0
        for m in self.special.finditer(text):
            yield from self._slices(text[at : m.start()])
            yield None
            at = m.end()
        yield from self._slices(text[at:] if at else text)

    def _slices(self, text: str) -> Iterator[str]:
        """Cut where white space is; a longer run without any stays whole."""
        at = 0
        while len(text) - at > 2 * SLICE and (cut := self.space.search(text, at + SLICE)):
            yield self.normalised(text[at : cut.start()])
            at = cut.start()
        if at < len(text):
            yield self.normalised(text[at:])

    def _add(self, parts: list[str], owner: list[int], total: np.ndarray) -> None:
        if not parts:
            return
        whole = " ".join(parts)  # the space ends a part's last word
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, inside = self._word_starts(points)
        data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        if len(data) == len(points):
            byte_in, first = inside, starts
        else:
            offset = np.cumsum(width) - width
            byte_in = np.repeat(inside, width)
            first = np.zeros(len(data), bool)
            first[offset[starts]] = True
        used = np.flatnonzero(byte_in)
        symbols = data[used]
        begin = first[used]
        ends = np.concatenate([begin[1:], [True]]) if len(used) else begin
        counts = self.transducer.count_words(symbols, ends)
        part_at = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
        part = np.searchsorted(part_at, np.flatnonzero(starts), side="right") - 1
        np.add.at(total, np.asarray(owner)[part], counts)


_loaded: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter for a tokenizers file, one per worker."""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row."""
    added = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    schema = StructType([*docs.select(id_col).schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in small_batches(batches):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            tokens = count.count(texts)
            sizes = pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64())
            columns = [batch.column(id_col), sizes, pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
