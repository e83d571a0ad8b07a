"""Byte-pair encoding by SentencePiece vocabularies, with vectorised merge rounds.

The vocabulary (pieces, scores, byte fallback) is read from a model file; encoding and
decoding are done here. The symbols of many words lie in one flat numpy array. A round
finds the best pair of every word (a segmented minimum of ranks), merges it in all words
at once, and compacts the array; words without a pair left are done.

Why a round is exact: the library merges the pair of best score first, the leftmost among
equals. Merging all occurrences of a word's best pair at once gives the same, unless the new
piece could start a better or equally good merge with a neighbour before the next occurrence
is merged. Pieces for which the vocabulary allows that are found beforehand (``solo``); of
those a round merges only the leftmost occurrence in a word.

A word here is a run of symbols that merges can't leave: texts are cut before each space mark
that follows another character, and between characters that no piece has side by side.
"""

from __future__ import annotations

import codecs
import re

import numpy as np

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_NONE = np.iinfo(np.int64).max


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)


class PieceCoder:
    """Encode and decode by a BPE model with the identity normaliser, a dummy prefix and byte fallback."""

    def __init__(self, model: bytes, max_words: int = 300_000):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if (trainer.model_type != 2 or not trainer.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or not spec.add_dummy_prefix or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix):
            raise ValueError("this coder takes BPE models with byte fallback, the identity normaliser and a dummy prefix")
        kind = {p: i for i, p in enumerate(("", "normal", "unknown", "control", "user", "unused", "byte"))}
        self.size = len(proto.pieces)
        kinds = np.array([p.type for p in proto.pieces])
        if (kinds == kind["user"]).any() or (kinds == kind["unused"]).any():
            raise ValueError("user-defined and unused pieces aren't supported")
        self.begin = next(i for i, p in enumerate(proto.pieces) if p.piece == (trainer.bos_piece or "<s>"))
        self.end = next(i for i, p in enumerate(proto.pieces) if p.piece == (trainer.eos_piece or "</s>"))
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind["normal"]}
        self.byte_id = np.zeros(256, np.int64)
        for i in np.flatnonzero(kinds == kind["byte"]):
            self.byte_id[int(proto.pieces[i].piece[1:-1], 16)] = i

        rank = np.unique([-p.score for p in proto.pieces], return_inverse=True)[1].astype(np.int64)
        self.char = np.arange(0x110000, dtype=np.int64) + self.size  # characters that are no piece come after the pieces
        for piece, i in normal.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        symbol = lambda s: int(self.char[ord(s)]) if len(s) == 1 else normal.get(s)
        self.width = self.size + 0x110000
        merges: dict[int, int] = {}
        solo = np.zeros(self.size, bool)
        beside: set[int] = set()
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                beside.add(ord(piece[k - 1]) << 21 | ord(piece[k]))
                left, right = symbol(piece[:k]), symbol(piece[k:])
                if left is None or right is None:
                    continue
                merges[left * self.width + right] = i
                for part in (left, right):
                    if part < self.size and rank[i] <= rank[part]:
                        solo[part] = True
        self.keys = np.array(sorted(merges), np.int64)
        self.made = np.array([merges[k] for k in self.keys.tolist()], np.int64)
        self.rank, self.solo = rank, solo
        self.beside = np.array(sorted(beside), np.int64)

        shown = [p.piece.replace(MARK, " ").encode() for p in proto.pieces]
        for i in range(self.size):
            if kinds[i] == kind["byte"]:
                shown[i] = bytes([int(proto.pieces[i].piece[1:-1], 16)])
            elif kinds[i] == kind["control"]:
                shown[i] = b""
            elif kinds[i] == kind["unknown"]:
                shown[i] = (trainer.unk_surface or " ⁇ ").encode()
        self.shown = shown
        self.shown_size = np.array([len(s) for s in shown])
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        self.shown_data = np.frombuffer(b"".join(shown), np.uint8)
        self.marked = np.array([k == kind["normal"] and p.piece.startswith(MARK) for k, p in zip(kinds, proto.pieces, strict=True)])
        self.silent = kinds == kind["control"]

        self.max_words = max_words
        self._forget()

    # -- words that were met before keep their ids, up to a bound

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.word_start = np.zeros(1024, np.int64)
        self.word_size = np.zeros(1024, np.int64)
        self.pool = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        ids, sizes = self._merge(words)
        n = len(self.words)
        while n + len(words) > len(self.word_start):
            self.word_start = np.concatenate([self.word_start, np.zeros_like(self.word_start)])
            self.word_size = np.concatenate([self.word_size, np.zeros_like(self.word_size)])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.word_start[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.word_size[n : n + len(words)] = sizes
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.words.update(zip(words, range(n, n + len(words)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, without begin and end, and how many each text has."""
        split = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        words = [w for ws in split for w in ws]
        fresh = list({w: None for w in words if w not in self.words})
        if fresh:
            if len(self.words) + len(fresh) > self.max_words:
                self._forget()
                fresh = list(dict.fromkeys(words))
            self._learn(fresh)
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        sizes = self.word_size[at]
        stop = np.cumsum(sizes)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.pool[np.arange(total) + np.repeat(self.word_start[at] - stop + sizes, sizes)]
        per_text = np.concatenate([[0], stop])[np.cumsum([0, *map(len, split)])]
        return ids, np.diff(per_text)

    # -- the merge rounds

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; the rank is ``_NONE`` where there is no piece."""
        if not len(self.keys):
            return np.full(len(left), _NONE), np.zeros(len(left), np.int64)
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = self.keys[at] == key
        made = self.made[at]
        return np.where(there, self.rank[made], _NONE), made

    def _segments(self, codes: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Whether each symbol starts a segment that no merge can join with what is before."""
        start = np.ones(len(codes), bool)
        key = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        start[1:] = (word[1:] != word[:-1]) | (self.beside[at] != key)
        # of a long run of space marks, pieces of 16 are made from the left; the last 17 to 32 marks stay together
        mark = codes == ord(MARK)
        if mark.sum() > 48:
            first = np.flatnonzero(mark & (start | ~np.append(False, mark[:-1])))
            end = np.flatnonzero(mark & np.append(start[1:] | ~mark[1:], True)) + 1
            for a, b in zip(first.tolist(), end.tolist(), strict=True):
                if b - a > 48:
                    start[np.arange(a, b - 32, 16)] = True
        return start

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        segment = np.cumsum(self._segments(codes, word)) - 1
        symbol, place = self.char[codes], np.arange(len(codes))
        rank, made = self._pairs(symbol[:-1], symbol[1:])
        rank = np.append(np.where(segment[1:] == segment[:-1], rank, _NONE), _NONE)
        made = np.append(made, 0)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            size = np.diff(np.append(first, len(segment)))
            best = np.repeat(np.minimum.reduceat(rank, first), size)
            over = best == _NONE
            if over.any():
                done.append((place[over], symbol[over]))
                go = ~over
                symbol, place, segment, rank, made, best = (x[go] for x in (symbol, place, segment, rank, made, best))
                if not len(symbol):
                    break
            chosen = np.flatnonzero(rank == best)
            # side by side, every second pair; of solo pieces only the leftmost in a segment
            run = np.ones(len(chosen), bool)
            run[1:] = np.diff(chosen) != 1
            at = np.arange(len(chosen))
            take = (at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0
            leftmost = np.append(True, segment[chosen[1:]] != segment[chosen[:-1]])
            chosen = chosen[np.where(self.solo[made[chosen]], leftmost, take)]
            symbol[chosen] = made[chosen]
            keep = np.ones(len(symbol), bool)
            keep[chosen + 1] = False
            changed = np.cumsum(keep)[chosen] - 1
            symbol, place, segment, rank, made = (x[keep] for x in (symbol, place, segment, rank, made))
            changed = np.unique(np.concatenate([changed, changed[changed > 0] - 1]))
            follows = np.minimum(changed + 1, len(symbol) - 1)
            inside = (follows > changed) & (segment[changed] == segment[follows])
            new_rank, made[changed] = self._pairs(symbol[changed], symbol[follows])
            rank[changed] = np.where(inside, new_rank, _NONE)
        place = np.concatenate([p for p, _ in done]) if done else np.zeros(0, np.int64)
        symbol = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(place)
        symbol, owner = symbol[order], word[place[order]]
        other = np.flatnonzero(symbol >= self.size)
        if len(other):  # characters without a piece become their bytes
            spelled = [self.byte_id[list(chr(c).encode())] for c in (symbol[other] - self.size).tolist()]
            times = np.ones(len(symbol), np.int64)
            times[other] = [len(s) for s in spelled]
            symbol, owner, other = np.repeat(symbol, times), np.repeat(owner, times), np.repeat(symbol >= self.size, times)
            symbol[other] = np.concatenate(spelled)
        return symbol, np.bincount(owner, minlength=len(words))

    # -- decoding

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The text of each sequence; control ids say nothing, and the dummy prefix goes."""
        ids = np.asarray(ids, np.int64)
        length = self.shown_size[ids]
        stop = np.cumsum(length)
        total = int(stop[-1]) if len(stop) else 0
        data = self.shown_data[np.arange(total) + np.repeat(self.shown_start[ids] - stop + length, length)].tobytes()
        ends = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(sizes)])]
        out, at = [], 0
        for k, n in enumerate(sizes.tolist()):
            spoken = ids[at : at + n]
            spoken = spoken[~self.silent[spoken]] if n and self.silent[spoken[[0, -1]]].any() else spoken
            raw = data[ends[k] : ends[k + 1]]
            if len(spoken) and self.marked[spoken[0]]:
                raw = raw[1:]
            out.append(raw.decode("utf-8", "each_byte"))
            at += n
        return out
