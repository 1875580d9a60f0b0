"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

Texts are cut into marked words, which no piece crosses. The distinct words are
sorted, so that they can be walked as a trie, depth first: what the forward pass
holds for a prefix serves every word that begins with it.

A unigram model keeps the best score of each prefix. For a BPE model a step from
piece u to piece v scores nought if the merges leave u and v apart, and minus
infinity if not; one path then has a score, and it is what the merges make.
"""

from __future__ import annotations

import os
from array import array
from dataclasses import dataclass, field
from functools import cache
from itertools import chain, repeat
from operator import eq, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackside.llm import chars, frames

SPACE = "▁"
WORDS_KEPT = 280_000  # encoded words that a worker remembers
PAIRS_KEPT = 400_000
NODES_KEPT = 170_000  # kinds of prefixes
COLUMNS = 96  # characters whose steps stand in a table
SHORT, LOT = 64, 1 << 17  # words that are walked side by side, and their characters
CHUNK = 1 << 20  # characters whose new words are encoded together
UNIGRAM, BPE = 1, 2
NOTHING = -(1 << 22)  # before the first piece
_NO_GUESS = 0, 0, 0
_NO_IDS = pa.array([], pa.list_(pa.int32()))


def _fields(data: bytes):
    """Numbers and contents of the fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Vocabulary:
    """What a model file says: its bytes, `kind`, pieces, scores, ids of bytes (-1
    if none), of the unknown piece, and of pieces that don't come from text."""

    model: bytes
    kind: int
    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    special: set[int] = field(default_factory=set)
    prefix: bool = True


def vocabulary(path: str) -> Vocabulary:
    """Read a model file, on the driver; the contents go to the tasks."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=path)
    n, model = processor.get_piece_size(), processor.serialized_model_proto()
    spec = {number: value for number, value in _fields(model) if number in (2, 3)}
    trainer, normaliser = dict(_fields(spec.get(2, b""))), dict(_fields(spec.get(3, b"")))
    kind = trainer.get(3, UNIGRAM)
    if kind not in (UNIGRAM, BPE):
        raise ValueError(f"models of kind {kind} are not supported")
    byte_ids = [-1] * 256
    for i in range(n):
        if processor.is_byte(i):
            byte_ids[int(processor.id_to_piece(i)[3:5], 16)] = i
    special = {
        i
        for i in range(n)
        if processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)
    }
    return Vocabulary(
        model,
        kind,
        [processor.id_to_piece(i) for i in range(n)],
        [processor.get_score(i) for i in range(n)],
        byte_ids,
        processor.unk_id(),
        special,
        bool(normaliser.get(3, 1)),
    )


def tokenizer() -> str:
    """The model file: SENTENCEPIECE_MODEL, or that of the public tokenizers."""
    import public_tokenizers

    return os.environ.get("SENTENCEPIECE_MODEL") or public_tokenizers.path("piece_bpe_32k.model")


class Encoder:
    """Encodes words; one to a Python worker, which keeps what it has encoded."""

    def __init__(self, words: Vocabulary, kept: int = WORDS_KEPT):
        self.kept, self.pairs_kept = kept, PAIRS_KEPT * kept // WORDS_KEPT
        self.nodes_kept = NODES_KEPT * kept // WORDS_KEPT
        self.chunk = CHUNK if kept >= WORDS_KEPT else CHUNK // 2
        from sentencepiece import SentencePieceProcessor

        self.own = words
        self.normalise = SentencePieceProcessor(model_proto=words.model).normalize
        self.score: dict[str, float] = {}
        after: dict[str, set[str]] = {}
        # an automaton of the pieces: steps by character, where to go on when there is
        # none, and the pieces that end at a state, the longest first
        self.steps: list[dict[str, int]] = [{}]
        self.found: list[tuple] = [()]
        for i, piece in enumerate(words.pieces):
            if i in words.special or not piece:
                continue
            self.score[piece] = words.scores[i]
            for a, b in zip(piece, piece[1:]):
                after.setdefault(b, set()).add(a)
            state = 0
            for c in piece:
                if c not in self.steps[state]:
                    self.steps[state][c] = len(self.steps)
                    self.steps.append({})
                    self.found.append(())
                state = self.steps[state][c]
            self.found[state] = ((len(piece), i),)
        self.back, self.depth = [0] * len(self.steps), [0] * len(self.steps)
        level = [0]
        while level:
            deeper = []
            for state in level:
                for c, child in self.steps[state].items():
                    back = self._go(self.back[state], c) if state else 0
                    self.back[child], self.depth[child] = back, self.depth[state] + 1
                    self.found[child] += self.found[back]
                    deeper.append(child)
            level = deeper
        self.classes = _classes(after)
        self.worst = min(self.score.values(), default=0.0) - 10.0
        self.pairs: dict[int, bool] = {}
        self.older: dict[int, bool] = {}
        self.guesses: dict[int, tuple[int, int, int]] = {}
        self.jumps: dict[int, tuple] = {}
        self.histories: dict[int, list | None] = {}
        # prefixes that go on alike, as they are met: steps by character, the last piece
        # and its length, the state, and the last pieces where pieces may go on from
        self.nodes: dict[tuple, int] = {}
        self.column: dict[str, int] = {}  # given out as characters come
        self.columns = np.full(chars.TOP, COLUMNS, np.int8)
        self.table = self._no_steps()
        self.far: dict[int, int] = {}  # steps by other characters
        self.node_last, self.node_size, self.node_state = array("i", [NOTHING]), array("i", [0]), [0]
        self.node_window: list[tuple[int, ...]] = [(NOTHING,)]
        self.index: dict[str, int] = {}
        self.flat = array("i")
        self.ends = array("q", [0])
        self.used = np.zeros(0, np.int64)  # how often each word came

    def forget(self) -> None:
        """Keep the words that have come more than once, if these are not most."""
        sizes = np.diff(self.ends)
        keep = self.used[: len(sizes)] > 1
        if 2 * keep.sum() > len(sizes):
            keep[:] = False
        flat = np.frombuffer(self.flat, dtype=np.int32)[np.repeat(keep, sizes)]
        place = np.cumsum(keep) - 1
        kept = keep.tolist()
        self.index = {w: int(place[i]) for w, i in self.index.items() if kept[i]}
        self.flat = array("i", flat.tobytes())
        self.ends = array("q", np.concatenate(([0], np.cumsum(sizes[keep]))).astype(np.int64).tobytes())
        self.used = np.zeros(0, np.int64)

    def _go(self, state: int, c: str) -> int:
        """The state after `c`: the longest end of what was read that begins a piece."""
        steps, back = self.steps, self.back
        while True:
            after = steps[state].get(c)
            if after is not None:
                return after
            if not state:
                return 0
            state = back[state]

    def words(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different marked words of normalised texts, which of them stands at each
        place, one text after the other, and how many places each text has."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = self.classes[np.minimum(codes, chars.TOP - 1)]
        cut = np.ones(len(codes) + 1, dtype=bool)
        before, now = kind[:-1], kind[1:]
        cut[1:-1] = (now == _MARK) & (before != _MARK) | (now == _SIGN) & (before == _LETTER)
        ends = np.cumsum([0, *map(len, texts)])
        cut[ends] = True
        at = np.flatnonzero(cut)
        n_words = np.diff(np.searchsorted(at, ends))
        if not joined.isascii():  # places in UTF-8
            width = np.ones(len(codes), np.uint8)
            for first in (0x80, 0x800, 0x10000):
                width += codes >= first
            at = np.append(0, np.cumsum(width, dtype=np.int64))[at]
        raw = pa.py_buffer(joined.encode("utf-8", "surrogatepass"))
        offsets = pa.py_buffer(at.astype(np.int64))
        every = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, offsets, raw]).dictionary_encode()
        if (codes >> 11 == 0x1B).any():  # surrogates, which Arrow takes for no text
            words = [w.as_py().decode("utf-8", "surrogatepass") for w in every.dictionary]
        else:
            words = every.dictionary.view(pa.large_string()).to_numpy(zero_copy_only=False).tolist()
        return words, every.indices.to_numpy(), n_words

    def _text(self, piece: int) -> str:
        return self.own.pieces[piece] if piece >= 0 else chr(-1 - piece)

    def _apart(self, u: int, v: int) -> bool:
        """Whether the merges make u and v, as they are, out of their joint text."""
        key = u << 21 | v
        known = self.older.get(key)
        if known is None:
            known = self._stays_apart(u, v)
        if len(self.pairs) >= self.pairs_kept // 2:
            self.older, self.pairs = self.pairs, {}
        self.pairs[key] = known
        return known

    def _history(self, piece: int):
        """How the merges make a piece out of its characters: the score of each merge, and
        the last and first part after it. None if they don't make it."""
        if piece in self.histories:
            return self.histories[piece]
        parts, out = list(self._text(piece)), []
        while len(parts) > 1:
            best, at = _best_merge(parts, self.score)
            if at < 0:
                out = None
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            out.append((best, parts[-1], parts[0]))
        if len(self.histories) >= self.pairs_kept // 4:
            self.histories.clear()
        self.histories[piece] = out
        return out

    def _stays_apart(self, u: int, v: int) -> bool:
        """Whether `merged` makes [u, v] out of their joint text: both histories run side
        by side, the better merge first, and no merge across comes before."""
        right = self._history(v)
        left = [] if u == NOTHING else self._history(u)
        if left is None or right is None:
            return False
        if u == NOTHING:
            return True
        score, edge, start = self.score.get, self._text(u)[-1], self._text(v)[0]
        a = b = 0
        while True:
            across = score(edge + start)
            if a < len(left) and (b == len(right) or left[a][0] >= right[b][0]):
                # of equal merges the leftmost comes first: here the one inside u
                if across is not None and across > left[a][0]:
                    return False
                edge, a = left[a][1], a + 1
            elif b < len(right):
                if across is not None and across >= right[b][0]:
                    return False
                start, b = right[b][2], b + 1
            else:
                return across is None

    def encode_sorted(self, words: list[str]):
        """The pieces of each of `words`, which are in order. A character without a
        piece is -1 minus its code point."""
        if self.own.kind == BPE:
            yield from self._merges(words)
            return
        before = ""
        # by length of prefix: last piece, where it starts, score, state
        last, start, total, states = [NOTHING], [0], [0.0], [0]
        for word in words:
            same = _shared(before, word)
            del last[same + 1 :], start[same + 1 :], total[same + 1 :], states[same + 1 :]
            self._score_walk(word, same, last, start, total, states)
            before, out, j = word, [], len(word)
            while j:
                out.append(last[j])
                j = start[j]
            yield out[::-1]

    def _merges(self, words: list[str]):
        """`encode_sorted` of a BPE model: a node for each prefix of the word before."""
        before, path = "", [0]
        for word in words:
            if len(self.node_last) > self.nodes_kept:
                self._forget_nodes()
                before, path = "", [0]
            same = _shared(before, word)
            del path[same + 1 :]
            for c in word[same:]:
                path.append(self._next(path[-1], c))
            before, out, j = word, [], len(word)
            while j:
                out.append(self.node_last[path[j]])
                j -= self.node_size[path[j]]
            yield out[::-1]

    def _side_by_side(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all `words` in a row, as `encode_sorted` gives them, and how many
        each has. Character after character, all words go from node to node at once."""
        if len(self.node_last) > self.nodes_kept:
            self._forget_nodes()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        size = lengths[order]
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        columns = self.columns[np.minimum(codes, chars.TOP - 1)]
        starts = (np.cumsum(lengths) - lengths)[order]
        longest = int(size[0]) if len(size) else 0
        going = np.searchsorted(-size, -np.arange(longest), "left")  # words longer than that
        node, path = np.zeros(len(words), np.int64), []
        for j, n in enumerate(going.tolist()):
            node, at = node[:n], starts[:n] + j
            after = self.table[node, columns[at]]
            missing = np.flatnonzero(after == 0)
            if len(missing):
                keys, of = np.unique(node[missing] << 21 | codes[at[missing]].astype(np.int64), return_inverse=True)
                found = [self._next(key >> 21, chr(key & 0x1FFFFF)) for key in keys.tolist()]
                after[missing] = np.array(found, np.int32)[of]
            path.append(after)
            node = after.astype(np.int64)
        nodes = np.concatenate([np.zeros(0, np.int32), *path])
        first = np.cumsum(going) - going
        last, length = np.array(self.node_last, np.int32), np.array(self.node_size, np.int64)
        # back from the ends of the words, piece by piece
        word, end, found = np.arange(len(words)), size, []
        while len(word):
            here = nodes[first[end - 1] + word]
            found.append((order[word], last[here]))
            end = end - length[here]
            word, end = word[end > 0], end[end > 0]
        of = np.concatenate([np.zeros(0, np.int64), *(w for w, _ in found)])
        numbers = np.bincount(of, minlength=len(words))
        nth = np.repeat(np.arange(len(found)), [len(w) for w, _ in found])
        out = np.empty(len(of), np.int32)
        out[np.cumsum(numbers)[of] - 1 - nth] = np.concatenate([np.zeros(0, np.int32), *(p for _, p in found)])
        return out, numbers

    def _no_steps(self) -> np.ndarray:
        """A table of steps that holds none: nought, as no step leads back to the start. The
        last column stays so. Memory is taken as nodes come, without copies of the table."""
        return np.zeros((self.nodes_kept + 1024, COLUMNS + 1), np.int32)

    def _forget_nodes(self) -> None:
        for of in (self.node_last, self.node_size, self.node_state, self.node_window):
            del of[1:]
        self.table = self._no_steps()
        for of in (self.nodes, self.far, self.guesses, self.jumps):
            of.clear()

    def _next(self, node: int, c: str) -> int:
        column = self.column.get(c)
        if column is None and len(self.column) < COLUMNS and ord(c) < chars.TOP - 1:
            column = self.columns[ord(c)] = self.column[c] = len(self.column)
        if column is None:
            key = node << 21 | ord(c)
            after = self.far.get(key)
            if after is None:
                after = self.far[key] = self._step(node, c)
            return after
        after = self.table.item(node, column)
        if not after:
            after = self._step(node, c)
            self.table[node, column] = after
        return after

    def _step(self, node: int, c: str) -> int:
        """The node after `node` and `c`. A piece that ends later starts where an end of the
        prefix begins a piece; prefixes are one node if they agree in the state, which says
        which these places are, and in the last pieces up to each: they go on alike."""
        window, before = self.node_window[node], self.node_state[node]
        jump = before << 21 | ord(c)
        known = self.jumps.get(jump)
        if known is None:
            known = self.jumps[jump] = self._jump(before, c)
        state, take, ends = known
        # only one piece can be the last of a prefix, so they may be tried in any order:
        # first the one that came here before
        pairs, here = self.pairs, jump << 22 | window[-1] & 0x3FFFFF
        at, n, piece = self.guesses.get(here, _NO_GUESS)
        if not n or not pairs.get(window[at] << 21 | piece):
            for at, n, piece in ends:
                apart = pairs.get(window[at] << 21 | piece)
                if apart or apart is None and self._apart(window[at], piece):
                    self.guesses[here] = at, n, piece
                    break
            else:
                n, piece = 1, -1 - ord(c)
        window = (*take(window), piece)
        key = (state, window)
        after = self.nodes.get(key)
        if after is None:
            after = self.nodes[key] = len(self.node_last)
            if after == len(self.table):
                self.table = np.pad(self.table, ((0, after // 2), (0, 0)))
            self.node_last.append(piece)
            self.node_size.append(n)
            self.node_state.append(state)
            self.node_window.append(window)
        return after

    def _starts(self, state: int) -> list[int]:
        """How far back those ends of the text begin that begin a piece, the longest first."""
        out = []
        while state:
            out.append(self.depth[state])
            state = self.back[state]
        return [*out, 0]

    def _jump(self, before: int, c: str):
        """The state after `before` and `c`; a function that takes from the window the places
        that stay in it; and the pieces that may end there: where in the window, how long
        and which."""
        state = self._go(before, c)
        place = {d: i - len(self._starts(before)) for i, d in enumerate(self._starts(before))}
        taken = tuple(place[d - 1] for d in self._starts(state)[:-1])
        at = taken[0] + len(place) if taken else 0
        take = itemgetter(*taken) if len(taken) > 1 else itemgetter(slice(at, at + len(taken)))
        return state, take, tuple((place[n - 1], n, piece) for n, piece in self.found[state])

    def _score_walk(self, word, same, last, start, total, states) -> None:
        scores, state = self.own.scores, states[same]
        for j, c in enumerate(word[same:], same):
            state = self._go(state, c)
            best, at, value = None, j, -np.inf
            for size, piece in self.found[state]:
                i = j + 1 - size
                if total[i] + scores[piece] > value:
                    best, at, value = piece, i, total[i] + scores[piece]
            if c not in self.score and total[j] + self.worst > value:
                best, at, value = -1 - ord(c), j, total[j] + self.worst
            last.append(best)
            start.append(at)
            total.append(value)
            states.append(state)

    def learn(self, words: set[str]) -> None:
        """Encode `words`, none of which is known yet."""
        new = sorted(words)
        rest = self.encode_sorted(new)
        if self.own.kind == BPE:
            short = [w for w in new if 0 < len(w) <= SHORT]
            new = [w for w in new if not 0 < len(w) <= SHORT]
            rest = self.encode_sorted(new)
            for i, j in chars.chunks(short, LOT):
                odd = self._learn_short(short[i:j])
                new += odd
                rest = chain(rest, odd.values())
        for word, pieces in zip(new, rest):
            if pieces and min(pieces) >= 0:
                self.flat.extend(pieces)
                pieces = ()
            for piece in pieces:
                if piece >= 0:
                    self.flat.append(piece)
                    continue
                raw = chr(-1 - piece).encode("utf-8", "surrogatepass")
                ids = [self.own.byte_ids[b] for b in raw]
                if min(ids) >= 0:
                    self.flat.extend(ids)
                elif len(self.flat) == self.ends[-1] or self.flat[-1] != self.own.unknown:
                    self.flat.append(self.own.unknown)
            self.index[word] = len(self.ends) - 1
            self.ends.append(len(self.flat))

    def _known(self, words: list[str]) -> np.ndarray:
        """The numbers of words, -1 for one that is not known."""
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def _learn_short(self, words: list[str]) -> dict[str, list[int]]:
        """Make words known; those with characters without a piece are given back."""
        pieces, sizes = self._side_by_side(words)
        ends = np.cumsum(sizes)
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(pieces < 0), "right"))
        out = {words[i]: pieces[ends[i] - sizes[i] : ends[i]].tolist() for i in odd.tolist()}
        if out:
            good = np.ones(len(words), bool)
            good[odd] = False
            pieces, sizes = pieces[np.repeat(good, sizes)], sizes[good]
            words = [w for w in words if w not in out]
        self.index.update(zip(words, range(len(self.ends) - 1, len(self.ends) - 1 + len(words))))
        self.ends.frombytes((len(self.flat) + np.cumsum(sizes)).astype(np.int64).tobytes())
        self.flat.frombytes(pieces.tobytes())
        return out

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's ids."""
        ids, sizes = [np.zeros(0, dtype=np.int32)], []
        for i, j in chars.chunks(texts, self.chunk):
            words, of, n_words = self.words([self.normalise(t) if t else "" for t in texts[i:j]])
            if len(self.index) > self.kept:
                self.forget()
            at = self._known(words)
            missing = np.flatnonzero(at < 0)
            if len(missing):
                new = [words[k] for k in missing.tolist()]
                self.learn(set(new))
                at[missing] = self._known(new)
            at = at[of]
            used = np.bincount(at, minlength=len(self.index))
            used[: len(self.used)] += self.used
            self.used = used
            ends, flat = np.array(self.ends, copy=True), np.frombuffer(self.flat, dtype=np.int32).copy()
            size = ends[at + 1] - ends[at]
            first = np.cumsum(size) - size
            place = np.arange(size.sum()) + np.repeat(ends[at] - first, size)
            ids.append(flat[place])
            doc = np.repeat(np.arange(j - i), n_words)
            sizes.append(np.bincount(doc, weights=size, minlength=j - i).astype(np.int64))
        return np.concatenate(ids), np.concatenate([np.zeros(0, dtype=np.int64), *sizes])


_LETTER, _SIGN, _MARK = 1, 2, 3


def _classes(after: dict[str, set[str]]) -> np.ndarray:
    """Classes of code points that tell where no piece crosses: before a space sign
    that follows anything else, and between a letter or digit and a sign that no
    piece has after one. `after`: by character what stands before it in pieces."""
    table = np.zeros(chars.TOP, dtype=np.uint8)
    table[:-1][chars.letter_table()[:-1]] = _LETTER
    table[ord("0") : ord("9") + 1] = _LETTER
    letter = lambda c: ord(c) < chars.TOP - 1 and table[ord(c)] == _LETTER
    for c in {*after, *chain.from_iterable(after.values()), *"\n\t\r.,;:!?"} - {SPACE}:
        if ord(c) < chars.TOP - 1 and not letter(c) and not any(map(letter, after.get(c, ()))):
            table[ord(c)] = _SIGN
    if not after.get(SPACE, set()) - {SPACE}:
        table[ord(SPACE)] = _MARK
    return table


def _shared(a: str, b: str) -> int:
    """How many characters two words begin with alike."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return same


def merged(text: str, score: dict[str, float]) -> list[str]:
    """The merges of a BPE model: of the neighbours that make a piece those with
    the best score first, the leftmost of equals."""
    parts = list(text)
    while len(parts) > 1:
        _, at = _best_merge(parts, score)
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _best_merge(parts: list[str], score: dict[str, float]) -> tuple[float | None, int]:
    best, at = None, -1
    for i in range(len(parts) - 1):
        found = score.get(parts[i] + parts[i + 1])
        if found is not None and (best is None or found > best):
            best, at = found, i
    return best, at


@cache
def _encoder(key: int, holder: _Held) -> Encoder:
    return Encoder(holder.own, key)


class _Held:
    """A vocabulary that counts as equal to any other copy of itself, so that a
    worker builds one encoder for it."""

    def __init__(self, own: Vocabulary):
        self.own, self.key = own, hash(own.model)

    def __eq__(self, other):
        return self.own.model == other.own.model

    def __hash__(self):
        return 0


def _listed(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    ids, sizes = encoder.encode(texts.to_pylist())
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=texts.is_null())


def encoded(text: Column, words: Vocabulary, kept: int = WORDS_KEPT) -> Column:
    """The ids of each text; none for an empty one, NULL for NULL. A character
    without a piece becomes its bytes, or the unknown piece if there are none."""
    held = _Held(words)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = _encoder(kept, held)
        lists = [_listed(encoder, some) for some in chars.slices(texts, encoder.chunk)]
        return pa.concat_arrays([_NO_IDS, *lists])

    return encode(text)


def _texts(lists: pa.ListArray, raw: list[bytes], prefix: bool) -> list[str | None]:
    """What lists of ids say, by the bytes of each id."""
    out = []
    for one in lists:
        if not one.is_valid:
            out.append(None)
            continue
        own = one.values.to_numpy(zero_copy_only=False)
        own = own[(own >= 0) & (own < len(raw))].astype(np.int64).tolist()
        text = b"".join(map(raw.__getitem__, own)).decode("utf-8", "replace")
        out.append(text[1:] if prefix and text[:1] == " " else text)
    return out


def _raw(words: Vocabulary) -> list[bytes]:
    """The bytes that each id stands for."""
    raw = [p.replace(SPACE, " ").encode("utf-8", "surrogatepass") for p in words.pieces]
    for i in words.special:
        raw[i] = b""
    for byte, i in enumerate(words.byte_ids):
        if i >= 0:
            raw[i] = bytes([byte])
    if words.unknown >= 0:
        raw[words.unknown] = " ⁇ ".encode()
    return raw


def decoded(ids: Column, words: Vocabulary) -> Column:
    """The text of each list of ids. Special ids and ids beyond the vocabulary give
    nothing, bytes that are no UTF-8 the replacement character; NULL gives NULL."""
    raw, prefix = _raw(words), words.prefix

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        return pa.array(_texts(lists, raw, prefix), pa.string())

    return decode(ids)


def round_trip(text: Column, words: Vocabulary, kept: int = WORDS_KEPT) -> Column:
    """A struct of `ids`, as `encoded` gives them, and `same_again`: whether `decoded` makes
    the text of them again (of NULL, NULL). One function does both, run by run: Spark
    would run `encoded` once for each column that is made of it."""
    held, raw, prefix = _Held(words), _raw(words), words.prefix

    @F.arrow_udf("struct<ids:array<int>,same_again:boolean>")
    def encode_and_decode(texts: pa.Array) -> pa.Array:
        encoder, lists, same = _encoder(kept, held), [_NO_IDS], []
        for some in chars.slices(texts, encoder.chunk):
            lists.append(_listed(encoder, some))
            same += map(eq, some.to_pylist(), _texts(lists[-1], raw, prefix))
        return pa.StructArray.from_arrays([pa.concat_arrays(lists), pa.array(same, pa.bool_())], ["ids", "same_again"])

    return encode_and_decode(text)


def with_ids(
    docs: DataFrame, words: Vocabulary, text: str = "text", kept: int = WORDS_KEPT // 2
) -> DataFrame:
    """`docs` with `ids`, in place of a column of that name; every row stays. Workers
    remember `kept` words: less than `encoded` alone, as whole rows pass them here."""
    rows = frames.packed(docs, text=text).withColumn("ids", encoded(F.col("text"), words, kept))
    return frames.unpacked(rows, docs.columns, ids=F.col("ids"))
