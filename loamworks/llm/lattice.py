"""Lattices of vocabulary pieces over many short strings at once, in numpy.

A unit is a run of text that no piece crosses. ``walk`` finds every piece at every position of all units by stepping a
trie in lockstep; ``forward`` sums all segmentations in log space, position by position for all units together.
Characters without a piece of their own become their UTF-8 bytes.

Memory is bounded by characters: callers pass at most ``CHUNK_CHARS`` of short units at once, and a unit beyond
``LONG_UNIT`` goes segment by segment. A segment needs of what lies before it only the sums at the last positions that a
piece can reach back to; its blocks' transfers between such states are found side by side and then chained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_CP = 21  # bits of a code point
#: Characters of units that are taken together.
CHUNK_CHARS = 200_000
#: Longer units are taken in segments, whose blocks are worked on side by side.
LONG_UNIT = 1_024
SEGMENT = 1 << 17
BLOCK = 256


@dataclass
class Vocabulary:
    """Pieces with natural-log weights that sum to one, the space written as a space; ids of the 256 bytes; the end."""

    pieces: list[str | None]
    log_weight: np.ndarray
    byte_ids: np.ndarray
    end_id: int


def load_vocabulary(path: str) -> Vocabulary:
    """A SentencePiece model's pieces and scores, read on the driver.

    Unigram models hold log probabilities. Merge-based models hold negative ranks instead; a piece of rank r then
    weighs 1/(r + 2), Zipf's law. Bytes and the end piece weigh as the last rank (or ten below the least score).
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    score = np.array([sp.get_score(i) for i in range(n)])
    byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    odd = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
    special = odd.copy()
    special[byte_ids] = True
    plain = score[~special]
    if np.all(plain == np.round(plain)):
        weight = -np.log(2.0 + np.minimum(np.abs(score), n))
        weight[byte_ids] = weight[sp.eos_id()] = -np.log(2.0 + n)
    else:
        weight = score.copy()
        weight[byte_ids] = weight[sp.eos_id()] = plain.min() - 10
    odd[sp.eos_id()] = False
    weight[odd] = -np.inf
    weight -= np.log(np.exp(weight).sum())
    return Vocabulary([None if special[i] else sp.id_to_piece(i).replace("▁", " ") for i in range(n)], weight, byte_ids, sp.eos_id())


class Lattice:
    """The vocabulary's trie, as sorted arrays."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        next_node: dict[int, int] = {}
        piece_of = [-1]
        for i, piece in enumerate(vocabulary.pieces):
            if piece is None:
                continue
            node = 0
            for ch in piece:
                key = node << _CP | ord(ch)
                if key not in next_node:
                    next_node[key] = len(piece_of)
                    piece_of.append(-1)
                node = next_node[key]
            piece_of[node] = i
        self.keys = np.array(sorted(next_node), np.int64)
        self.nodes = np.array([next_node[k] for k in self.keys.tolist()], np.int64)
        self.piece_of = np.array(piece_of, np.int64)
        self.reach = max((len(p) for p in vocabulary.pieces if p), default=1)  # characters of the longest piece
        self.first = np.full(1 << _CP, -1, np.int32)
        top = self.keys < 1 << _CP
        self.first[self.keys[top]] = self.nodes[top]
        # Open addressing: a quarter full, probed in lockstep.
        self.bits = max(4, (4 * len(self.keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int64)
        left = np.arange(len(self.keys))
        at = self._slot(self.keys)
        while len(left):
            free = self.slots[at] < 0
            _, firsts = np.unique(np.where(free, at, -1), return_index=True)
            firsts = firsts[free[firsts]]
            self.slots[at[firsts]] = self.keys[left[firsts]]
            self.values[at[firsts]] = self.nodes[left[firsts]]
            rest = np.ones(len(left), bool)
            rest[firsts] = False
            left, at = left[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _step(self, keys: np.ndarray) -> np.ndarray:
        """Next node, or -1."""
        at = self._slot(keys)
        got = self.slots[at]
        out = np.where(got == keys, self.values[at], -1)
        open_ = np.flatnonzero((got != keys) & (got >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got = self.slots[at[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (got >= 0)]
        return out

    def walk(self, units: list[str]) -> tuple["Layout", np.ndarray]:
        """(layout, piece[l, i]): the id of the piece of l+1 characters that starts at character i; -1: none, -2: the
        character's bytes."""
        lay = Layout(units)
        cps, after = lay.cps, lay.after
        piece = np.full((min(self.reach, max(1, int(lay.size.max(initial=0)))), len(cps)), -1, np.int32)
        node = self.first[cps].astype(np.int64)
        found = np.where(node >= 0, self.piece_of[node], -1)
        piece[0] = np.where(found < 0, -2, found)
        at = np.flatnonzero((node >= 0) & (after >= 0))
        node, char = node[at], after[at]
        for row in piece[1:]:
            node = self._step(node << _CP | cps[char])
            ok = node >= 0
            at, node, char = at[ok], node[ok], after[char[ok]]
            row[at] = self.piece_of[node]
            ok = char >= 0
            at, node, char = at[ok], node[ok], char[ok]
        return lay, piece

    def byte_weight(self, cps: np.ndarray) -> np.ndarray:
        """Of characters that become bytes; all bytes weigh the same."""
        return (1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)) * self.vocabulary.log_weight[self.vocabulary.byte_ids[0]]

    def forward(self, units: list[str], power: float = 1.0, chances: bool = False) -> tuple["Layout", np.ndarray, np.ndarray, np.ndarray | None]:
        """(layout, piece, alpha, cdf). alpha[i]: the log of the summed weight of all segmentations of the unit up to and
        with character i, weights raised to ``power``. With ``chances`` cdf[i, l]: the chance that the last piece of such
        a segmentation has at most l+1 characters, 1 from the longest possible piece on."""
        kind = np.float32 if chances else np.float64
        lay, piece = self.walk(units)
        table = np.append(self.vocabulary.log_weight * power, -np.inf).astype(kind)
        alpha = np.zeros(len(lay.cps), kind)
        cdf = np.ones((len(lay.cps), len(piece)), kind) if chances else None
        off = lay.level_start.tolist()
        raw = (self.byte_weight(lay.cps) * power).astype(kind)
        for p in range(len(off) - 1):
            here = slice(off[p], off[p + 1])
            m = off[p + 1] - off[p]
            reach = min(p + 1, len(piece))
            terms = np.empty((reach, m), kind)
            for step in range(reach):
                start = slice(off[p - step], off[p - step] + m)
                ids = piece[step, start]
                got = table[ids]
                if step == 0:
                    got = np.where(ids == -2, raw[start], got)
                terms[step] = got if step == p else got + alpha[off[p - step - 1] : off[p - step - 1] + m]
            top = terms.max(0)
            np.exp(terms - top, out=terms)
            if chances:
                left = np.zeros(m, kind)  # of longer pieces; exactly 0 beyond the longest
                rest = np.empty((reach, m), kind)
                for step in range(reach - 1, -1, -1):
                    rest[step] = left
                    left = left + terms[step]
                cdf[here, :reach] = (1 - rest / left).T
                total = left
            else:
                total = terms.sum(0)
            alpha[here] = top + np.log(total)
        return lay, piece, alpha, cdf

    def log_marginal(self, units: list[str]) -> np.ndarray:
        """The log of each unit's summed weight over all its segmentations; 0 for an empty unit."""
        out = np.zeros(len(units))
        for part in chunks(units):
            if len(units[part[0]]) > LONG_UNIT:
                *_, last = self.states(units[part[0]])
                out[part[0]] = last[0]
                continue
            lay, _, alpha, _ = self.forward([units[i] for i in part])
            out[part] = alpha[lay.level_start[lay.size - 1] + lay.rank]
        return out

    def arriving(self, unit: str, start: int, end: int, power: float) -> tuple[np.ndarray, np.ndarray]:
        """(weight[l, j], piece[l, j]): of the piece of l+1 characters that ends right after character start + j."""
        lead = min(start, self.reach - 1)
        text = unit[start - lead : end]
        lay, piece = self.walk([text])
        weight = np.append(self.vocabulary.log_weight * power, -np.inf)[piece]
        weight[0] = np.where(piece[0] == -2, self.byte_weight(lay.cps) * power, weight[0])
        to, ids = np.full((self.reach, end - start), -np.inf), np.full((self.reach, end - start), -1, np.int32)
        for step in range(len(piece)):
            begin = max(0, step - lead)  # the first end that has such a start
            to[step, begin:] = weight[step, begin + lead - step : len(text) - step]
            ids[step, begin:] = piece[step, begin + lead - step : len(text) - step]
        return to, ids

    def states(self, unit: str, power: float = 1.0) -> Iterator[np.ndarray]:
        """The state before each segment of a long unit, and at its end: the log sums of all segmentations up to the last
        ``reach`` places, the nearest first."""
        state = np.full(self.reach, -np.inf)
        state[0] = 0.0
        yield state
        for start in range(0, len(unit), SEGMENT):
            weight, _ = self.arriving(unit, start, min(start + SEGMENT, len(unit)), power)
            state = _chained(weight, state)[-1]
            yield state

    def segment(self, unit: str, start: int, state: np.ndarray, power: float) -> tuple[np.ndarray, np.ndarray]:
        """(piece[l, j], cdf[j, l]) of the segment of a long unit from ``start`` on, given the state before it: as
        ``forward`` has them with ``chances``, but by the character that a piece ends with."""
        weight, ids = self.arriving(unit, start, min(start + SEGMENT, len(unit)), power)
        n = weight.shape[1]
        before = _chained(weight, state)[: -(-n // BLOCK)]
        blocks = _blocks(weight)  # [l, block, place]
        cdf = np.ones((blocks.shape[1], BLOCK, self.reach), np.float32)
        last = [before[:, k] for k in range(self.reach)]
        for t in range(BLOCK):
            terms = np.stack([x + w for x, w in zip(last, blocks[:, :, t])])
            total = _log_sum(terms)
            rest = np.exp(terms - np.where(np.isfinite(total), total, 0.0))[::-1].cumsum(0)[::-1]
            cdf[:, t, :-1] = (1 - rest[1:] / np.where(rest[0] > 0, rest[0], 1.0)).T  # exactly 1 beyond the longest
            last = [total, *last[:-1]]
        return ids, cdf.reshape(-1, self.reach)[:n]


def chunks(units: list[str]) -> Iterator[list[int]]:
    """The numbers of the non-empty units in runs of at most ``CHUNK_CHARS``; a long unit is alone."""
    held: list[int] = []
    chars = 0
    for i, u in enumerate(units):
        if held and (chars + len(u) > CHUNK_CHARS or len(u) > LONG_UNIT):
            yield held
            held, chars = [], 0
        if len(u) > LONG_UNIT:
            yield [i]
        elif u:
            held.append(i)
            chars += len(u)
    if held:
        yield held


def _log_sum(terms: np.ndarray) -> np.ndarray:
    """Over the first axis; -inf where nothing is summed."""
    top = terms.max(0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(terms - safe).sum(0))


def _blocks(weight: np.ndarray) -> np.ndarray:
    """[l, block, place]; the last block is filled up with places that nothing reaches."""
    reach, n = weight.shape
    many = -(-n // BLOCK)
    out = np.full((reach, many * BLOCK), -np.inf)
    out[:, :n] = weight
    return out.reshape(reach, many, BLOCK)


def _chained(weight: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The state before each block of a segment, and after its last character."""
    reach, n = weight.shape
    whole = n // BLOCK
    states = [state]
    if whole:
        blocks = np.exp(_blocks(weight[:, : whole * BLOCK]))
        # ring[place % reach, block, b]: up to that place, from the state with 1 at its place b alone, over exp(scale)
        ring = np.eye(reach)[:, None].repeat(whole, 1)
        scale = np.zeros((whole, reach))
        back = -np.arange(reach)  # the state's k-th place is k before the block
        for t in range(BLOCK):
            own = np.empty((reach, whole))
            own[(t + back) % reach] = blocks[:, :, t]
            ring = ring if t else ring[back % reach]
            ring[(t + 1) % reach] = np.einsum("kxb,kx->xb", ring, own)
            top = ring.max(0)
            top[top == 0] = 1
            ring /= top
            scale += np.log(top)
        with np.errstate(divide="ignore"):
            move = (np.log(ring[(BLOCK + back) % reach]) + scale).transpose(1, 0, 2)  # [block, to, from]
        for m in move:
            states.append(_log_sum((m + states[-1]).T))
    if n > whole * BLOCK:
        end = states[-1]
        for w in weight[:, whole * BLOCK :].T:
            end = np.concatenate([[_log_sum((end + w)[:, None])[0]], end[:-1]])
        states.append(end)
    return np.stack(states)


class Layout:
    """The units' characters by their place in the unit, the longest unit first: those at one place are neighbours."""

    def __init__(self, units: list[str]) -> None:
        self.size = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(-self.size, kind="stable")
        self.rank = np.empty(len(units), np.int64)
        self.rank[order] = np.arange(len(units))
        by = self.size[order]
        at_least = len(units) - np.searchsorted(by[::-1], np.arange(1, int(by[0] if len(by) else 0) + 1))
        self.level_start = np.concatenate([[0], np.cumsum(at_least)])
        flat = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        begin = np.cumsum(self.size) - self.size
        place = np.arange(len(flat)) - np.repeat(begin, self.size)
        to = self.level_start[place] + np.repeat(self.rank, self.size)
        self.cps = np.empty(len(flat), np.int64)
        self.cps[to] = flat
        #: Of the next character, or -1.
        self.after = np.full(len(flat), -1, np.int64)
        follows = place[1:] > 0
        self.after[to[:-1][follows]] = to[1:][follows]
