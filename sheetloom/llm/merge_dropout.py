"""Subword encoding with seeded merge dropout, and decoding.

A word, with the blanks before it, is cut into characters, which are merged pair by pair. All possible merges
wait on an agenda, the best-scored first, of equal ones the leftmost. With dropout, a merge whose turn comes is
passed over if a keyed hash says so, which gives another segmentation for each key, all of which decode to the
same text. The key is the seed, the document (its id and text), the number of the word in the text, the place in the
word and the piece that would be made, so every occurrence of a word is drawn anew, and results do not depend on
partitions, order or retries.

What a worker remembers is no draw: it is what the agenda does with a word after given steps were passed over, up to the
next one that is. An occurrence draws every step of its own and follows these states. Where none is known yet its
agenda is worked off under its own key, next to those of others, one step of each at a time; a state is remembered
when it is reached again.

Pieces and scores come from a public model file of the merge type; nothing is trained. With dropout 0 the ids
are those of the file's own library. A character without a piece of its own is written as its UTF-8 bytes, and so
is a literal U+2581, which would read as a blank otherwise; every text decodes to itself.

Defined results: a null text is encoded as the empty one and decodes to it; an empty text has no ids; repeated rows
have equal ids; a null list of ids decodes to null; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import mixed, slices, text_of, utf8, whole_rows, with_outputs

MODEL = "piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 1
#: Words, and states of their agendas, that a worker remembers at most.
REMEMBERED = 200_000
REMEMBERED_STATES = 400_000
#: Words drawn in one numpy step, and bytes of texts taken together.
BLOCK, TOGETHER = 1 << 17, 1 << 20
#: Longest word whose agenda is worked off next to others; a longer one has a heap of its own.
SIDE_BY_SIDE = 31

BLANK = "▁"
#: A literal U+2581 of a text. Longer than any character, so no piece of the file holds it.
_LITERAL = "\x00▁"
_RUNS = re.compile(r"( *)([^ ]*)")
_ALL = (1 << 64) - 1
_PLACE, _PIECE, _MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB


def model_file(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Turn of a pair that makes nothing, after all others.
NEVER = 1 << 30


class _PairTable:
    """Made piece and turn by pair key, looked up for many keys at once: a key has one place in each of a few tables."""

    BITS = 18

    def __init__(self, keys: np.ndarray, made: np.ndarray, turns: np.ndarray) -> None:
        self._levels = []
        values = made << 32 | turns  # both in one look
        left = np.arange(len(keys))
        while len(left):
            place = self._place(keys[left], len(self._levels))
            taken, first = np.unique(place, return_index=True)
            held, value = np.full(1 << self.BITS, -2, np.int64), np.zeros(1 << self.BITS, np.int64)
            held[taken], value[taken] = keys[left[first]], values[left[first]]
            self._levels.append((held, value))
            left = np.delete(left, first)

    def _place(self, keys: np.ndarray, level: int) -> np.ndarray:
        spread = keys.view(np.uint64) * np.uint64((_PLACE, _PIECE, _MIX)[level % 3] + 2 * (level // 3))
        return (spread >> np.uint64(64 - self.BITS)).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape, keys = keys.shape, np.ascontiguousarray(keys).ravel()
        found = np.full(len(keys), -1 << 32 | NEVER, np.int64)
        open_ = np.flatnonzero(keys >= 0)
        for level, (held, value) in enumerate(self._levels):
            mine = keys[open_]
            place = self._place(mine, level)
            hit = held[place] == mine
            found[open_[hit]] = value[place[hit]]
            open_ = open_[~hit]
        return (found >> 32).astype(np.int32).reshape(shape), (found & 0xFFFFFFFF).astype(np.int32).reshape(shape)


class Vocabulary:
    """Pieces of a model file: ids and scores by piece, ids by byte, the bytes of each id, and all pairs that merge."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[int] = [0] * 256
        self.written: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.written.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.written.append(b"")
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.written.append(piece.replace(BLANK, " ").encode())
        self._raw = {piece: i.to_bytes(4, "little") for piece, i in self.ids.items()}
        self._number()

    def _number(self) -> None:
        """The same as sorted arrays: single characters, and pairs of ids with the id and the turn of what they make."""
        self.size = len(self.written)
        #: The same bytes as one table, and where each id's begin, for many ids at once.
        self.byte_table = np.frombuffer(b"".join(self.written), np.uint8)
        self.byte_counts = np.array([len(w) for w in self.written], np.int64)
        self.byte_begins = np.cumsum(self.byte_counts) - self.byte_counts
        singles = sorted((ord(p), i) for p, i in self.ids.items() if len(p) == 1)
        self.characters, self.character_ids = np.array(singles, np.int64).reshape(-1, 2).T
        turn = {score: n for n, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        pairs = sorted(
            (self.ids[p[:k]] * self.size + self.ids[p[k:]], i, turn[self.scores[p]])
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in self.ids and p[k:] in self.ids
        )
        self._pairs = _PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What two neighbours make, and its turn; NEVER where they make nothing."""
        return self._pairs.find(np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -1))

    def spelled(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit numbers; bytes stand in for a character without a piece."""
        known = self._raw.get(piece)
        if known is not None:
            return known
        raw = (BLANK if piece == _LITERAL else piece).encode()
        return b"".join([self.bytes[b].to_bytes(4, "little") for b in raw])


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]




def _passed_over(key: int, left: int, piece: int, limit: int) -> bool:
    """Whether the merge that makes ``piece`` at ``left`` is skipped under ``key``."""
    state = (key ^ (left * _PLACE + piece * _PIECE)) & _ALL
    return (((state ^ (state >> 31)) * _MIX) & _ALL) >> 32 < limit


def merged(symbols: list[str], words: Vocabulary, dropout: float = 0.0, key: int = 0) -> list[str]:
    """Pieces that the agenda leaves of a run of characters. ``key`` decides which merges are passed over."""
    limit, scores, n = int(dropout * (1 << 32)), words.scores, len(symbols)
    pieces, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[float, int, str]] = []

    def suggest(left: int, made: str) -> None:
        score = scores.get(made)
        if score is not None:
            heapq.heappush(agenda, (-score, left, made))

    for left in range(n - 1):
        suggest(left, pieces[left] + pieces[left + 1])
    while agenda:
        _, left, made = heapq.heappop(agenda)
        right = after[left]
        if not pieces[left] or right >= n or pieces[left] + pieces[right] != made:
            continue  # a part of it has been merged since
        if limit and _passed_over(key, left, words.ids[made], limit):
            continue
        pieces[left], pieces[right] = made, ""
        after[left] = behind = after[right]
        if behind < n:
            before[behind] = left
            suggest(left, made + pieces[behind])
        if before[left] >= 0:
            suggest(before[left], pieces[before[left]] + made)
    return [p for p in pieces if p]


def merged_many(ids: np.ndarray, words: Vocabulary, passed: Callable, record: bool = False) -> tuple[np.ndarray, ...]:
    """:func:`merged` for many words at once: a row of ids for each, negative ones for characters without a piece.

    Rows are filled up with -1. In every step each row that still has a merge takes its best one, or
    passes it over where ``passed`` (of rows, step and what is hashed with a key) says so. A merged piece stands where its
    left part stood, and -1 where its right part was, so places stay as they are and neighbours are told by links.
    A row of 32 has at most 93 steps. With ``record``, row, step and hashed term of every merge looked at come along.
    """
    width = ids.shape[1]
    out, rows, step, seen = ids.astype(np.int32), np.arange(len(ids)), 0, []
    ids = np.column_stack([out, np.full(len(out), -1, np.int32)])  # the place behind the last one
    after = np.repeat(np.arange(1, width + 2, dtype=np.int32)[None], len(ids), 0)
    before = after - 2
    made, turns = words.merge_of(ids[:, :-1], ids[:, 1:])
    while True:
        at = turns.argmin(axis=1) if len(rows) else np.zeros(0, np.int64)  # of equal turns the leftmost
        line = np.flatnonzero(turns[np.arange(len(rows)), at] < NEVER)
        if len(line) < 0.7 * len(rows) or not len(line):  # rows that are done leave, many at a time
            out[rows] = ids[:, :width]
            if not len(line):
                break
            rows, ids, after, before, made, turns, at = (x[line] for x in (rows, ids, after, before, made, turns, at))
            line = np.arange(len(rows))
        at = at[line]
        piece = made[line, at]
        term = at.astype(np.uint64) * np.uint64(_PLACE) + piece.astype(np.uint64) * np.uint64(_PIECE)
        if record:
            seen.append((rows[line], np.full(len(line), step), term))
        skipped = passed(rows[line], step, term)
        step += 1
        turns[line[skipped], at[skipped]] = NEVER
        line, at, piece = line[~skipped], at[~skipped], piece[~skipped]
        right = after[line, at]
        behind = after[line, right]
        ids[line, at], ids[line, right], turns[line, np.minimum(right, width - 1)] = piece, -1, NEVER
        after[line, at], before[line, behind] = behind, at
        left = before[line, at]
        inside = left >= 0
        # the pairs that the new piece is part of
        row, one, two = np.concatenate([line, line[inside]]), np.concatenate([at, left[inside]]), np.concatenate([behind, at[inside]])
        made[row, one], turns[row, one] = words.merge_of(ids[row, one], ids[row, two])
    row, steps, terms = (np.concatenate(x) for x in zip(*seen, strict=True)) if seen else (np.zeros(0, np.int64),) * 3
    return out, row, steps, terms.astype(np.uint64)


def _hits(keys: np.ndarray, terms: np.ndarray, limit: np.uint64) -> np.ndarray:
    """:func:`_passed_over` for many."""
    state = keys ^ terms
    return ((state ^ (state >> np.uint64(31))) * np.uint64(_MIX)) >> np.uint64(32) < limit


class _Grown:
    """An array that grows at its end."""

    def __init__(self, dtype: str) -> None:
        self.held, self.size = np.zeros(1024, dtype), 0

    def add(self, values: np.ndarray) -> int:
        """Append; where the values begin."""
        begin, self.size = self.size, self.size + len(values)
        if self.size > len(self.held):
            more = np.zeros(max(self.size, 2 * len(self.held)), self.held.dtype)
            more[:begin] = self.held[:begin]
            self.held = more
        self.held[begin : self.size] = values
        return begin


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of runs, one run after the other."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


class Encoder:
    """Ids under one seed, as 32-bit numbers. ``draw`` stands for the document where none is given."""

    def __init__(self, words: Vocabulary, dropout: float, seed: int, draw: int = 0) -> None:
        self._vocabulary, self._dropout, self._draw = words, dropout, draw
        self._limit = np.uint64(int(dropout * (1 << 32)))
        self._seed = np.uint64(xxhash.xxh64_intdigest(str(seed).encode()))
        self.forget()

    def forget(self) -> None:
        """Let go of what is remembered."""
        self._numbers: dict[str, int] = {}
        # by word: its symbols, and the state in which nothing was passed over (-1: not known yet, -2: a heap of its own)
        self._symbols, self._symbols_at, self._width, self._root = (_Grown(t) for t in ("<i8", "<i8", "<i8", "<i8"))
        # by state: its word, the steps passed over, the first step still to draw, and where its steps and ids are
        self._word, self._low, self._high, self._first = (_Grown(t) for t in ("<i8", "<u8", "<u8", "<i8"))
        self._steps_at, self._steps, self._ids_at, self._length = (_Grown(t) for t in ("<i8", "<i8", "<i8", "<i8"))
        # by step: what is hashed with the key, and the state that passing over leads to (-1: never, -2: reached once)
        self._terms, self._leads, self._ids = _Grown("<u8"), _Grown("<i8"), _Grown("<i4")
        self._known = 0  # words of earlier blocks

    def _keys_of(self, draws: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Key of each occurrence: the seed, the document and the number of the word in the text."""
        return mixed(mixed(draws.astype(np.uint64) ^ self._seed) + places.astype(np.uint64) * np.uint64(_PLACE))

    def spell(self, blanks: int, word: str, key: int | None = None) -> bytes:
        """Ids of a word behind some blanks. No piece joins a character to a blank behind it."""
        if key is None:
            key = int(self._keys_of(np.array([self._draw], np.int64), np.zeros(1, np.int64))[0])
        symbols = [BLANK] * blanks + [_LITERAL if c == BLANK else c for c in word]
        pieces = merged(symbols, self._vocabulary, self._dropout, key)
        return b"".join([self._vocabulary.spelled(p) for p in pieces])

    @property
    def _words(self) -> dict[str, bytes]:
        """Remembered words with their ids at the first place of a text."""
        return {word: self._spell_all([word], {}, self._keys_of(np.array([self._draw]), np.zeros(1)))[0].tobytes() for word in self._numbers}

    def _learn(self, fresh: list[str]) -> None:
        """Number words behind one blank, and keep their symbols, those of about the same length together."""
        groups: dict[int, list[str]] = {}
        for word in fresh:
            if word not in self._numbers:
                width = (len(word) + 4) // 4 * 4
                self._numbers[word] = -1
                groups.setdefault(width if width <= SIDE_BY_SIDE + 1 and "\0" not in word else 0, []).append(word)
        words = self._vocabulary
        for width, members in groups.items():
            self._numbers.update(zip(members, range(self._root.size, self._root.size + len(members)), strict=True))
            self._width.add(np.full(len(members), width))
            self._root.add(np.full(len(members), -1 if width else -2))
            self._symbols_at.add(self._symbols.size + width * np.arange(len(members)))
            if width:
                codes = np.array(members, f"<U{width - 1}").view(np.uint32).reshape(len(members), width - 1).astype(np.int64)
                at = np.minimum(np.searchsorted(words.characters, codes), len(words.characters) - 1)
                plain = (words.characters[at] == codes) & (codes != ord(BLANK))
                ids = np.where(plain, words.character_ids[at], np.where(codes == 0, -1, -1 - codes))
                self._symbols.add(np.column_stack([np.full(len(members), words.ids[BLANK]), ids]).ravel())

    def _by_width(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of about the same length, as places in ``numbers`` and rows of symbols."""
        wide = (self._width.held[numbers] + 7) // 8 * 8
        for width in np.unique(wide).tolist():
            mine = np.flatnonzero(wide == width)
            own = self._width.held[numbers[mine]][:, None]
            at = self._symbols_at.held[numbers[mine]][:, None] + np.arange(width)
            yield mine, np.where(np.arange(width) < own, np.take(self._symbols.held, at, mode="clip"), -1)

    def _written(self, done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids row after row, negative ones as the bytes of their character, and how many each row has."""
        held = done != -1
        flat, length = done[held], held.sum(axis=1)
        strange = flat < 0
        if not strange.any():
            return flat, length
        codes, which = np.unique(flat[strange], return_inverse=True)
        parts = [np.frombuffer(self._vocabulary.spelled(_LITERAL if c == ord(BLANK) else chr(c)), "<i4") for c in (-1 - codes).tolist()]
        size = np.array([len(p) for p in parts])
        sizes = np.ones(len(flat), np.int64)
        sizes[strange] = size[which]
        out = np.repeat(flat, sizes)
        into = _spread((np.cumsum(sizes) - sizes)[strange], size[which])
        out[into] = np.concatenate(parts)[_spread((np.cumsum(size) - size)[which], size[which])]
        return out, np.bincount(np.repeat(np.arange(len(length)), length), sizes, len(length)).astype(np.int64)

    def _reach(self, numbers: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray) -> np.ndarray:
        """New states of words, given the steps passed over (bits, from 64 on in ``high``) and the first step behind them."""
        states = np.empty(len(numbers), np.int64)
        for mine, ids in self._by_width(numbers):
            masks = low[mine], high[mine]
            done, row, step, term = merged_many(
                ids, self._vocabulary, lambda rows, step, _, m=masks: (m[step >> 6][rows] >> np.uint64(step & 63)) & np.uint64(1) > 0, True
            )
            later = step >= first[mine][row]
            row, term = row[later], term[later]
            steps = np.bincount(row, minlength=len(mine))
            at = self._terms.add(term[np.argsort(row, kind="stable")])
            self._leads.add(np.full(len(term), -1))
            flat, length = self._written(done)
            ids_at = self._ids.add(flat)
            states[mine] = self._word.size + np.arange(len(mine))
            for table, values in (
                (self._word, numbers[mine]), (self._low, masks[0]), (self._high, masks[1]), (self._first, first[mine]),
                (self._steps, steps), (self._steps_at, at + np.cumsum(steps) - steps),
                (self._length, length), (self._ids_at, ids_at + np.cumsum(length) - length),
            ):
                table.add(values)
        return states

    def _drawn(self, numbers: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The state each occurrence ends in, -1 if it is not known. Every step looked at is drawn under the occurrence's key."""
        again = np.bincount(numbers, minlength=self._root.size) > 1
        again[: self._known] = True
        fresh = np.flatnonzero(again & (self._root.held[: self._root.size] == -1))
        self._known = self._root.size
        none = np.zeros(len(fresh), np.uint64)
        self._root.held[fresh] = self._reach(fresh, none, none, none.astype(np.int64))
        state = self._root.held[numbers]
        open_ = np.flatnonzero(state >= 0) if self._limit else np.zeros(0, np.int64)
        while len(open_):
            steps = self._steps.held[state[open_]]
            owner = np.repeat(open_, steps)
            at = _spread(self._steps_at.held[state[open_]], steps)
            passed = np.flatnonzero(_hits(keys[owner], self._terms.held[at], self._limit))
            passed = passed[np.diff(owner[passed], prepend=-1) != 0]  # the first one of each
            open_, edge = owner[passed], at[passed]
            edges, which, times = np.unique(edge, return_index=True, return_counts=True)
            lead = self._leads.held[edges]
            learn = (lead == -2) | ((lead == -1) & (times > 1))
            self._leads.held[edges[(lead == -1) & ~learn]] = -2
            if learn.any():
                before, edges = state[open_[which[learn]]], edges[learn]
                step = self._first.held[before] + edges - self._steps_at.held[before]
                bit = np.uint64(1) << (step & 63).astype(np.uint64)
                low = self._low.held[before] | np.where(step < 64, bit, np.uint64(0))
                high = self._high.held[before] | np.where(step < 64, np.uint64(0), bit)
                self._leads.held[edges] = self._reach(self._word.held[before], low, high, step + 1)
            state[open_] = np.maximum(self._leads.held[edge], -1)
            open_ = open_[state[open_] >= 0]
        return state

    def _spell_all(self, words: list[str], blanks: dict[int, int], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has. ``blanks`` by position where it is not one."""
        if len(self._numbers) > REMEMBERED or self._word.size > REMEMBERED_STATES:
            self.forget()
        self._learn(list(set(words).difference(self._numbers)))
        numbers = np.fromiter(map(self._numbers.__getitem__, words), np.int64, len(words))
        state = self._drawn(numbers, keys)
        state[list(blanks)] = -2
        known, length = state >= 0, np.zeros(len(words), np.int64)
        length[known] = self._length.held[state[known]]
        found = [(np.array([k]), ids, np.array([len(ids)])) for k, ids in (
            (k, np.frombuffer(self.spell(blanks.get(k, 1), words[k], int(keys[k])), "<i4")) for k in np.flatnonzero(state == -2).tolist()
        )]
        first = np.flatnonzero(state == -1)
        for mine, ids in self._by_width(numbers[first]):
            own = keys[first[mine]]
            done = merged_many(ids, self._vocabulary, lambda rows, _, term, own=own: _hits(own[rows], term, self._limit))[0]
            found.append((first[mine], *self._written(done)))
        for which, _, sizes in found:
            length[which] = sizes
        begin = np.cumsum(length) - length
        out = np.empty(int(length.sum()), "<i4")
        out[_spread(begin[known], length[known])] = self._ids.held[_spread(self._ids_at.held[state[known]], length[known])]
        for which, ids, sizes in found:
            out[_spread(begin[which], sizes)] = ids
        return out, length

    def encode_many(self, texts: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and how many each has."""
        words: list[str] = []
        sizes, blanks = [], {}
        for text in texts:
            begin = len(words)
            if "  " not in text and text[:1] != " ":
                words += text.split(" ") if text else []
            else:
                runs = [(len(b), word) for b, word in _RUNS.findall(" " + text) if b or word]
                blanks |= {begin + k: b for k, (b, _) in enumerate(runs) if b != 1}
                words += [word for _, word in runs]
            sizes.append(len(words) - begin)
        counts = np.array(sizes, np.int64)
        keys = self._keys_of(np.repeat(draws, counts), _spread(np.zeros(len(counts), np.int64), counts))
        done = []
        for k in range(0, len(words), BLOCK):
            here = {at - k: b for at, b in blanks.items() if k <= at < k + BLOCK} if blanks else {}
            done.append(self._spell_all(words[k : k + BLOCK], here, keys[k : k + BLOCK]))
        flat, lengths = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, "<i4"), np.zeros(0, np.int64))
        before = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return flat, np.diff(before)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text], np.array([self._draw], np.int64))[0].tobytes()


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(path: str, dropout: float, seed: int) -> Encoder:
    key = (path, dropout, seed)
    if key not in _ENCODERS:
        if len(_ENCODERS) >= 4:
            _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary(path), dropout, seed)
    return _ENCODERS[key]


def encode(text: Column, draw: Column, path: str | None = None, dropout: float = DROPOUT, seed: int = SEED) -> Column:
    """Ids of a text column as an array of ints; ``draw`` is a long that stands for the document."""
    if not 0 <= dropout <= 1:
        raise ValueError("dropout is a share")
    path = path or model_file()

    @F.arrow_udf("array<int>")
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = _encoder(path, dropout, seed)
        for texts, draws in batches:
            drawn = draws.to_numpy(zero_copy_only=False)
            done = [
                encoder.encode_many(texts[first:last].to_pylist(), drawn[first:last])
                for first, last in slices(utf8(texts)[1], TOGETHER)
            ]
            flat, sizes = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, "<i4"), np.zeros(0, np.int64))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        encoder.forget()  # an idle worker should hold the vocabulary only

    return of(text, draw)


def decoded(ids: pa.Array, words: Vocabulary) -> pa.Array:
    """Texts of an Arrow array of lists of ids, without the blank that each begins with; null stays null.

    Bytes are gathered from one table, :data:`TOGETHER` at a time.
    """
    ends = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.int64)
    ends -= ends[0]
    before = np.concatenate([[0], np.cumsum(words.byte_counts[flat])])[ends]  # bytes before each text
    done = []
    for first, last in slices(before, TOGETHER):
        mine = flat[ends[first] : ends[last]]
        raw = words.byte_table[_spread(words.byte_begins[mine], words.byte_counts[mine])]
        begins = before[first : last + 1] - before[first]
        sizes = np.diff(begins)
        stays = np.ones(len(raw), bool)
        stays[begins[:-1][sizes > 0]] = False
        offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes - 1, 0))]).astype(np.int32)
        texts = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(offsets), pa.py_buffer(raw[stays].tobytes())])
        try:
            done.append(texts.cast(pa.string()))
        except pa.ArrowInvalid:  # ids that no text was encoded to
            done.append(pa.array([t.as_py().decode("utf-8", "replace") for t in texts], pa.string()))
    found = pa.concat_arrays(done) if done else pa.array([], pa.string())
    return pc.if_else(ids.is_valid(), found, pa.scalar(None, pa.string())) if ids.null_count else found


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of an array of ids."""
    path = path or model_file()

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = vocabulary(path)
        for batch in batches:
            yield decoded(batch, words)

    return of(ids)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """All columns of ``docs`` and ``ids``."""
    rows = whole_rows(docs, text=text_of(text_col), draw=F.xxhash64(F.col(id_col), text_of(text_col)))
    return with_outputs(rows.select("row", encode(F.col("text"), F.col("draw"), **params).alias("ids")), docs, ["ids"])
