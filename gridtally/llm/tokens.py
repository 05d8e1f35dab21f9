"""Token ids of whole texts by a public tokenizer file, piece by piece from a bounded memory."""

from __future__ import annotations

import os
from array import array
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from gridtally.llm.hashing import text_bytes

# Strings whose ids a worker remembers, some 80 MB; beyond that it starts anew. An executor has a worker for each core.
REMEMBERED = 400_000
# Strings that are encoded in one text, with this word between them.
TOGETHER = 512
BETWEEN = "0"

SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
# Classes of bytes: white space, letters, digits, marks, and all that leaves a text to the tokenizer. Of
# UTF-8 the lead bytes of Latin letters and of dashes and quotes are known; bytes that go on take the class
# of their lead.
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[0x21:0x7F] = MARK
_CLASS[[0x09, 0x0A, 0x0D, 0x20]] = SPACE
_CLASS[0x30:0x3A] = DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _CLASS[0xC3] = LETTER
_CLASS[0xE2] = MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SPACE_BEFORE_SPACE = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}] "

_encoders: dict[tuple, Encoder] = {}


def tokenizer_path(name: str) -> str:
    """Place of an installed tokenizer file; every executor has the package that holds it."""
    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, equal to encoding each whole text with the tokenizer as it is in the file.

    Both kinds of tokenizer part a text into runs of letters, digits and marks before they merge; one drops
    white space, the other (`keeps_space`) starts a run with the space before it. Texts of known characters
    are parted for many texts at once, others at their spaces, and only strings that are not remembered are
    encoded. Texts that hold the name of a special token are encoded whole, and so are, where space is
    kept, those in which white space stands before a space.
    """

    def __init__(self, path: str, keeps_space: bool) -> None:
        # executors give a task one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keeps_space = keeps_space
        self.lead = " " if keeps_space else ""
        self._forget()
        (self.between,) = self._whole([f"{self.lead}{BETWEEN}"])[0].tolist()
        self.line = int(self._whole(["a\na"])[0][1])

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.n_ids = np.zeros(1 << 20, np.uint32), 0
        self.ends = np.zeros(REMEMBERED // 4, np.int64)

    def _whole(self, texts: Sequence[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.frombuffer(array("I", f.ids).tobytes(), np.uint32) for f in found]

    def _remember(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, more = len(self.place), self.n_ids + len(ids)
        if more > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)))
        if n + len(strings) >= len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros(max(len(self.ends), len(strings)), np.int64)))
        self.ids[self.n_ids : more] = ids
        self.ends[n + 1 : n + 1 + len(strings)] = self.n_ids + np.cumsum(sizes)
        self.n_ids = more
        self.place.update(zip(strings, range(n, n + len(strings))))

    def _alone(self, strings: list[str]) -> None:
        if strings:
            found = self._whole(strings)
            self._remember(strings, np.concatenate(found), np.array([len(f) for f in found], np.int64))

    def _together(self, strings: list[str], join: str, cut: int) -> None:
        """Remember strings by encoding many of them as one text, cut at the id of what is between."""
        groups = [strings[i : i + TOGETHER] for i in range(0, len(strings), TOGETHER)]
        for group, ids in zip(groups, self._whole([join.join(g) for g in groups])):
            cuts = np.flatnonzero(ids == cut)
            if len(cuts) == len(group) - 1:
                self._remember(group, np.delete(ids, cuts), np.diff(cuts, prepend=-1, append=len(ids)) - 1)
            else:
                self._alone(group)

    def _learn(self, strings: Sequence[str]) -> None:
        lead = len(self.lead)
        joined, lines, rest = [], [], []
        for s in strings:
            if s.startswith(self.lead) and len(s) > lead and BETWEEN not in s and not s[-1].isspace():
                joined.append(s)
            elif lead and s.isascii() and s.isalpha():
                lines.append(s)
            else:
                rest.append(s)
        self._together(joined, f" {BETWEEN}" if lead else f" {BETWEEN} ", self.between)
        self._together(lines, "\n", self.line)
        self._alone(rest)

    def _places(self, strings: list[str]) -> np.ndarray:
        """Where the ids of strings are remembered."""
        found = list(map(self.place.get, strings))
        new = list({s for s, at in zip(strings, found) if at is None})
        if new:
            if len(self.place) + len(new) > REMEMBERED:
                self._forget()
                new = list(set(strings))
            self._learn(new)
            found = list(map(self.place.__getitem__, strings))
        return np.array(found, np.int64)

    def _gather(self, places: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.ends[places]
        n = self.ends[places + 1] - starts
        ends = np.concatenate(([0], np.cumsum(n)))
        return self.ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], n)], ends[offsets]

    def _by_words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids by the words between spaces."""
        lists = pc.split_pattern(column, " ") if self.keeps_space else pc.ascii_split_whitespace(column)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        code = coded.indices.to_numpy().astype(np.int64)
        keys = coded.dictionary.to_pylist()
        if self.keeps_space:
            # the first word of a text has no space before it
            heads = [keys[i] for i in code[offsets[:-1]].tolist()]
            code[offsets[:-1]] = np.arange(len(heads)) + len(keys)
            keys = [f" {w}" for w in keys] + heads
        return self._gather(self._places(keys)[code], offsets)

    def _parted(self, data: np.ndarray, kind: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which bytes begin a piece, and which belong to one; `first` marks the first bytes of texts."""
        low = _LOWER[data] if not self.keeps_space else data
        new = first.copy()
        new[1:] |= kind[1:] != kind[:-1]
        # whether the byte after is of the same text, and of which kind
        goes_on = np.append(~first[1:], False)
        after = np.append(kind[1:], OTHER)
        if self.keeps_space:
            ending = np.flatnonzero((kind == SPACE) & goes_on & (after != SPACE))
            alone = (data[ending] == 0x20) & new[ending]
            new[ending] = True
            new[ending[alone] + 1] = False
        else:
            new |= kind == DIGIT
        at = np.flatnonzero((low == ord("'")) & new & goes_on & (after == LETTER))
        if len(at):
            padded = np.append(low, np.zeros(2, np.uint8))
            one, two = padded[at + 1], padded[at + 2]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = np.zeros(len(at), bool)
            for x, y in ("re", "ve", "ll"):
                long |= (one == ord(x)) & (two == ord(y)) & goes_on[at + 1]
            new[at[short | long] + 1] = False
            tails = np.concatenate((at[short] + 2, at[long] + 3))
            new[tails[tails < len(new)]] = True
        return new, np.ones(len(data), bool) if self.keeps_space else kind != SPACE

    def _by_pieces(self, data: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids by pieces, found for all bytes at once."""
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        new, kept = self._parted(data, kind, first[:-1])
        if not self.keeps_space:
            data = _LOWER[data]
            second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
            data[second] += 32
        before = np.concatenate(([0], np.cumsum(kept)))
        starts = np.flatnonzero(new & kept)
        bounds = np.append(before[starts], before[-1]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[kept].tobytes()))
        coded = words.dictionary_encode()
        places = self._places(coded.dictionary.to_pylist())
        return self._gather(places[coded.indices.to_numpy()], np.searchsorted(starts, offsets))

    def arrays(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and where each text's begin; null is empty."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        data, offsets = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        odd = np.zeros(len(column), bool)
        for name in self.special:
            odd |= pc.match_substring(column, name).to_numpy(zero_copy_only=False)
        if self.keeps_space:
            odd |= pc.match_substring_regex(column, _SPACE_BEFORE_SPACE).to_numpy(zero_copy_only=False)
        kind = _CLASS[data]
        on = np.flatnonzero((data & 0xC0) == 0x80)
        lead = data[on - 1]
        letter = (lead == 0xC3) & (data[on] != 0x97) & (data[on] != 0xB7)
        quote = ((lead == 0xE2) & (data[on] == 0x80)) | ((lead == 0x80) & (data[on - 2] == 0xE2) & (data[on] >= 0x90) & (data[on] <= 0xA7))
        kind[on[letter]], kind[on[quote]] = LETTER, MARK
        strange = np.concatenate(([0], np.cumsum(kind == OTHER)))
        other = ~odd & (strange[offsets[1:]] > strange[offsets[:-1]]) & (np.diff(offsets) < 1 << 30)
        if not odd.any() and not other.any() and len(data) < 1 << 30:
            return self._by_pieces(data, kind, offsets)
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(column)
        for i, found in zip(np.flatnonzero(odd).tolist(), self._whole(column.filter(pa.array(odd)).to_pylist())):
            parts[i] = found
        if other.any():
            ids, ends = self._by_words(column.filter(pa.array(other)))
            for i, a, b in zip(np.flatnonzero(other).tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                parts[i] = ids[a:b]
        for i in np.flatnonzero(~odd & ~other).tolist():
            a, b = int(offsets[i]), int(offsets[i + 1])
            if a < b:
                parts[i] = self._by_pieces(data[a:b], kind[a:b], np.array([0, b - a]))[0]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))

    def encode(self, texts: Sequence[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as unsigned 32-bit integers, lowest byte first; null is empty."""
        ids, offsets = self.arrays(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker's encoder of a tokenizer file, kept from task to task."""
    if (path, keeps_space) not in _encoders:
        _encoders[path, keeps_space] = Encoder(path, keeps_space)
    return _encoders[path, keeps_space]


def drop_encoders() -> None:
    """Free the worker's encoders, some 200 MB, when it goes on to texts that are not tokenized."""
    _encoders.clear()
