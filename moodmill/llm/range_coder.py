"""Adaptive context-mixing range coder for blocks of 16-bit token ids.

Three orders predict the next id: a table by the last two ids, a table by the last id, and a table of
recently seen ids. The coded symbol says which prediction is right (order 2, order 1, or a slot
of the order-0 table, whose number follows), or else the size class of the id, whose offset in the class
follows. The symbol's distribution mixes three adaptive ones, conditioned on the confidence of the
predictions, on the last symbol and on nothing; their weights follow how well each has predicted.
Symbols go through the range coder; slot numbers and offsets, which are taken as uniform, follow as
plain bits.
All of it is integer arithmetic, so a decoder on any machine repeats it.

A block starts from empty tables, so blocks are independent. Many are coded side by side: every
numpy operation works on one id of each block.
"""

from __future__ import annotations

import numpy as np

ORDER2 = 1024
ORDER1 = 512
ORDER0 = 256
SYMBOLS = 8
HIT2, HIT1, HIT0, FIRST_CLASS = 0, 1, 2, 3
#: First id of each size class and the bits of an offset in it.
CLASS_START = np.array([0, 512, 2048, 8192, 16384], dtype=np.int64)
CLASS_BITS = np.array([9, 11, 13, 13, 16], dtype=np.int64)
SYMBOL_BITS = 12
TOTAL = 1 << SYMBOL_BITS
RATE = 5
LEAST = 32
MIX_BITS = 3
#: Ids after which the weights of the mixture are set anew.
LOOK = 8
#: Blocks that are coded side by side.
LANES = 4096

#: A distribution is a row of upper bounds, one per symbol; the last is TOTAL.
_BOUND = np.arange(1, SYMBOLS + 1)
#: Row s: where the bounds move after symbol s.
_TARGET = np.where(
    _BOUND[None, :] <= np.arange(SYMBOLS)[:, None],
    _BOUND * LEAST,
    TOTAL - (SYMBOLS - _BOUND) * LEAST,
).astype(np.int16)
_START = (_BOUND * (TOTAL // SYMBOLS)).astype(np.int16)
#: Eight 16-bit bounds as one element, so that rows are gathered and scattered at once.
_ROW = np.complex128
_TARGET_ROWS = _TARGET.reshape(-1).view(_ROW)
#: Row w: the weight w once for each bound.
_WEIGHT_ROWS = np.repeat(np.arange((1 << MIX_BITS) + 1, dtype=np.uint16), SYMBOLS).view(_ROW)
#: A 16-bit number times this is that number four times.
_FOUR_TIMES = np.uint64(0x0001_0001_0001_0001)
_ONE = np.uint32(1)
_U16 = np.uint32(16)
_SHIFT = np.uint32(SYMBOL_BITS)
_FULL = np.uint32(0xFFFFFFFF)
_SMALL = np.uint32(0x10000)
#: Symbol by size class (three bits) and, above these, whether orders 0, 1 and 2 are right.
_CHOSEN = np.array(
    [HIT2 if i & 32 else HIT1 if i & 16 else HIT0 if i & 8 else FIRST_CLASS + (i & 7) for i in range(64)], dtype=np.int64
)
_RAW_BITS = np.r_[0, 0, 8, CLASS_BITS]
_RAW_START = np.r_[0, 0, 0, CLASS_START].astype(np.int64)
_RAW_MASK = (1 << _RAW_BITS) - 1
_CLASS_EDGES = CLASS_START[1:].astype(np.uint16)
#: Where a decoder has the id of a symbol: a prediction, or what follows from the plain bits.
_ROW_OF = np.minimum(np.arange(SYMBOLS), FIRST_CLASS)
#: How sure an entry is next, by its difference from the id that came (see ``_Model.compare``), 4 for all above.
_SURE = np.array([1, 2, 3, 3, 1], dtype=np.int32)


class _Model:
    """The predictions of every lane; ``n`` lanes from the first on are still running.

    An entry of a table holds an id and, in its two lowest bits, how sure it is (0: empty). The id that came
    replaces a wrong one.
    """

    def __init__(self, lanes: int) -> None:
        self.lane = np.arange(lanes, dtype=np.int64)
        self.by_two = np.zeros(lanes * ORDER2, dtype=np.int32)
        self.by_one = np.zeros(lanes * ORDER1, dtype=np.int32)
        # A slot begins with its own number, which is an id of that slot.
        self.recent = np.tile(np.arange(ORDER0, dtype=np.uint16), lanes)
        self.a = np.tile(_START, lanes * 16).view(_ROW)
        self.b = np.tile(_START, lanes * SYMBOLS).view(_ROW)
        self.c = np.tile(_START, lanes)
        self.lane_two, self.lane_one, self.lane_recent, self.lane_a, self.lane_row = (
            self.lane * n for n in (ORDER2, ORDER1, ORDER0, 16, SYMBOLS)
        )
        self.score = np.full((3, lanes), 1 << 12, dtype=np.int32)
        self.weight: list[np.ndarray] = []
        self.last = np.zeros(lanes, dtype=np.int64)
        self.before = np.zeros(lanes, dtype=np.int64)
        self.symbol = np.full(lanes, FIRST_CLASS, dtype=np.int64)
        self.step = 0

    def predict(self, n: int) -> np.ndarray:
        """Mixed cumulative distribution of the next symbol, a row per lane."""
        near = self.last[:n] * 40503
        at = self.before[:n] * 9973
        at += near
        at &= ORDER2 - 1
        at += self.lane_two[:n]
        near >>= 5
        near &= ORDER1 - 1
        near += self.lane_one[:n]
        self.at_two, self.at_one = at, near
        self.two, self.one = self.by_two.take(at), self.by_one.take(near)
        self.sure2, self.sure1 = self.two & 3, self.one & 3
        self.row_a = self.lane_a[:n] + ((self.sure2 << 2) | self.sure1)
        self.row_b = self.lane_row[:n] + self.symbol[:n]
        self.pa = self.a.take(self.row_a).view(np.int16)
        self.pb = self.b.take(self.row_b).view(np.int16)
        self.pc = self.c[: n * SYMBOLS]
        if self.step % LOOK == 0:
            share = (self.score[:2] << MIX_BITS) // self.score.sum(axis=0)
            rest = (1 << MIX_BITS) - share[0] - share[1]
            self.weight = [_WEIGHT_ROWS.take(w).view(np.uint16) for w in (share[0], share[1], rest)]
        w = self.weight
        mixed = self.pa.view(np.uint16) * w[0][: n * SYMBOLS]
        mixed += self.pb.view(np.uint16) * w[1][: n * SYMBOLS]
        mixed += self.pc.view(np.uint16) * w[2][: n * SYMBOLS]
        mixed >>= np.uint16(MIX_BITS)
        return mixed

    def compare(self, ids: np.ndarray) -> None:
        """Turn the predictions into their differences from the ids: 1 to 3 is right and as sure as that."""
        self.entry = ids.astype(np.int32)
        self.entry <<= 2
        self.two ^= self.entry
        self.one ^= self.entry

    def learn(self, n: int, symbol: np.ndarray, ids: np.ndarray) -> None:
        if self.step % LOOK == 0:
            at = self.lane_row[:n] + symbol
            for k, p in enumerate((self.pa, self.pb, self.pc)):
                mass = _interval(p, at)[1].astype(np.int32)
                self.score[k, :n] += (mass - self.score[k, :n]) >> 3
            np.maximum(self.score, 1, out=self.score)
        self.step += 1
        target = _TARGET_ROWS.take(symbol).view(np.int16)
        self.a[self.row_a] = _moved(self.pa, target).view(_ROW)
        self.b[self.row_b] = _moved(self.pb, target).view(_ROW)
        self.c[: n * SYMBOLS] = _moved(self.pc, target)
        for table, at, differs in ((self.by_two, self.at_two, self.two), (self.by_one, self.at_one, self.one)):
            sure = _SURE.take(np.minimum(differs.view(np.uint32), 4))
            sure |= self.entry
            table[at] = sure
        self.recent[self.lane_recent[:n] + (ids & (ORDER0 - 1))] = ids.astype(np.uint16)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids
        self.symbol[:n] = symbol


def _moved(p: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bound a part of the way towards its target, rounded down."""
    step = target - p
    step >>= RATE
    step += p
    return step


def _interval(bounds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First count and number of counts of the symbols at these places; before a lane's first is another's TOTAL."""
    first = bounds.take(at - 1).astype(np.uint32)
    first &= np.uint32(TOTAL - 1)
    return first, bounds.take(at).astype(np.uint32) - first


def _transposed(rows: np.ndarray) -> np.ndarray:
    """A copy with rows and columns exchanged, made in strips that a processor's cache holds."""
    out = np.empty(rows.shape[::-1], dtype=rows.dtype)
    for at in range(0, rows.shape[0], 64):
        out[:, at : at + 64] = rows[at : at + 64].T
    return out


def _padded(blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks as rows, longest first, with their lengths and the order they came from."""
    lengths = np.array([len(b) for b in blocks], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    ids = np.zeros((len(blocks), int(lengths.max(initial=0))), dtype=np.uint16)
    for row, source in enumerate(order):
        ids[row, : lengths[source]] = blocks[source]
    return ids, lengths[order], order


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    out: list[bytes] = []
    for at in range(0, len(blocks), LANES):
        out.extend(_encode_lanes(blocks[at : at + LANES]))
    return out


def _encode_lanes(blocks: list[np.ndarray]) -> list[bytes]:
    table, lengths, order = _padded(blocks)
    lanes, longest = table.shape
    rows = _transposed(table)
    model = _Model(lanes)
    low = np.zeros(lanes, dtype=np.uint32)
    width = np.full(lanes, _FULL, dtype=np.uint32)
    # A symbol costs at most one word, and two end the block.
    words = np.zeros((lanes, longest + 4), dtype=np.uint32)
    flat = words.reshape(-1)
    begin = model.lane * (longest + 4)
    used = begin.copy()
    # Order 2 right, which has no plain bits, stands where a lane has ended.
    kinds = np.full((longest, lanes), HIT2, dtype=np.int8)
    running = np.searchsorted(-lengths, -np.arange(longest), side="left").tolist()
    for step, n in enumerate(running):
        short_ids = rows[step, :n]
        ids = short_ids.astype(np.int64)
        mixed = model.predict(n)
        hits = (model.recent.take(model.lane_recent[:n] + (ids & (ORDER0 - 1))) == short_ids).view(np.int8) << 3
        model.compare(ids)
        hits |= (model.one.view(np.uint32) - _ONE < 3).view(np.int8) << 4
        hits |= (model.two.view(np.uint32) - _ONE < 3).view(np.int8) << 5
        for start in _CLASS_EDGES:
            hits += short_ids >= start
        symbol = _CHOSEN.take(hits)
        kinds[step, :n] = symbol
        first, share = _interval(mixed, model.lane_row[:n] + symbol)
        unit = width[:n] >> _SHIFT
        first *= unit
        total = low[:n] + first
        share *= unit
        carry = np.flatnonzero(total < first)
        if len(carry):
            place = used[carry] - 1
            while len(carry):
                flat[place] += np.uint32(1)
                more = flat[place] > 0xFFFF
                flat[place[more]] = 0
                carry, place = carry[more], place[more] - 1
        short = np.flatnonzero(share < _SMALL)
        out = total.take(short)
        at = used.take(short)
        flat[at] = out >> _U16
        at += 1
        used[short] = at
        total[short] = out << _U16
        share[short] <<= _U16
        low[:n], width[:n] = total, share
        model.learn(n, symbol, ids)
    for _ in range(2):
        flat[used] = low >> _U16
        used += 1
        low <<= _U16
    used -= begin
    plain = _packed(table, kinds)
    out = [b""] * lanes
    for row, source in enumerate(order):
        head = np.array([used[row]], dtype="<u4").tobytes()
        out[source] = head + words[row, : used[row]].astype("<u2").tobytes() + plain[row]
    return out


def _packed(rows: np.ndarray, kinds: np.ndarray) -> list[bytes]:
    """The plain bits of each lane: slot numbers and offsets in turn, in 16-bit words."""
    lanes, longest = rows.shape
    out: list[bytes] = []
    for some in range(0, lanes, 64):
        kind = kinds[:, some : some + 64].T.astype(np.int64)
        bits = _RAW_BITS.take(kind)
        value = rows[some : some + 64] - _RAW_START.take(kind)
        value &= _RAW_MASK.take(kind)
        end = np.cumsum(bits, axis=1)
        at = end - bits
        # A value lies in the 32 bits from its first word on; fields do not overlap, so sums are unions.
        value <<= 32 - (at & 15) - bits
        used = (end[:, -1] + 15 >> 4) + 1 if longest else np.ones(len(value), dtype=np.int64)
        stride = longest + 2
        at >>= 4
        at += np.arange(len(value))[:, None] * stride
        # Sums of 32-bit fields stay exact in a double.
        sums = np.bincount(at.reshape(-1), weights=value.reshape(-1), minlength=len(value) * stride).astype(np.int64)
        words = sums >> 16
        words[1:] += sums[:-1] & 0xFFFF
        lines = words.astype("<u2").reshape(len(value), stride)
        out.extend(lines[i, : used[i]].tobytes() for i in range(len(value)))
    return out


def decode(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for at in range(0, len(payloads), LANES):
        out.extend(_decode_lanes(payloads[at : at + LANES], lengths[at : at + LANES]))
    return out


def _matrix(parts: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Word streams as the rows of one flat array, with spare zeros, and the row length."""
    size = max(map(len, parts), default=0) + 4
    words = np.zeros((len(parts), size), dtype=np.uint32)
    for row, part in enumerate(parts):
        words[row, : len(part)] = part
    return words.reshape(-1), size


def _decode_lanes(payloads: list[bytes], counts: list[int]) -> list[np.ndarray]:
    lengths = np.array(counts, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    lanes, longest = len(order), int(lengths.max(initial=0))
    heads = [min(int.from_bytes(payloads[i][:4], "little"), len(payloads[i]) // 2 - 2) for i in order]
    parts = [np.frombuffer(payloads[i][4:], dtype="<u2") for i in order]
    words, size = _matrix([p[:h] for p, h in zip(parts, heads, strict=True)])
    plain, plain_size = _matrix([p[h:] for p, h in zip(parts, heads, strict=True)])
    # A value may lie in two words, so both are read at once.
    plain <<= _U16
    plain[:-1] |= plain[1:] >> _U16
    model = _Model(lanes)
    row = model.lane * size
    code = (words[row] << _U16) | words[row + 1]
    used = row + 2
    last_word = row + size - 1
    bit = model.lane * (plain_size * 16)
    last_bit = bit + (plain_size - 2) * 16
    width = np.full(lanes, _FULL, dtype=np.uint32)
    rows = np.zeros((longest, lanes), dtype=np.uint16)
    running = np.searchsorted(-lengths, -np.arange(longest), side="left").tolist()
    choice = np.empty((4, lanes), dtype=np.int64)
    for step, n in enumerate(running):
        mixed = model.predict(n)
        unit = width[:n] >> _SHIFT
        value = np.minimum(code[:n] // unit, np.uint32(TOTAL - 1))
        # The number of bounds at or below the value: eight truth bytes of a lane counted at once.
        lined = np.empty((n, 2), dtype=np.uint64)
        np.multiply(value, _FOUR_TIMES, out=lined[:, 0])
        lined[:, 1] = lined[:, 0]
        below = np.less_equal(mixed, lined.reshape(-1).view(np.uint16)).view(np.uint64)
        symbol = np.bitwise_count(below).astype(np.int64)
        first, share = _interval(mixed, model.lane_row[:n] + symbol)
        first *= unit
        rest = code[:n] - first
        share *= unit
        short = np.flatnonzero(share < _SMALL)
        at = used.take(short)
        rest[short] = (rest.take(short) << _U16) | words.take(at)
        at += 1
        used[short] = at
        share[short] <<= _U16
        code[:n], width[:n] = rest, share
        bits = _RAW_BITS.take(symbol)
        at = bit[:n]
        value = plain.take(at >> 4).astype(np.int64)
        value >>= 32 - (at & 15) - bits
        value &= _RAW_MASK.take(symbol)
        np.right_shift(model.two, 2, out=choice[HIT2, :n])
        np.right_shift(model.one, 2, out=choice[HIT1, :n])
        choice[HIT0, :n] = model.recent.take(model.lane_recent[:n] + (value & (ORDER0 - 1)))
        np.add(value, _RAW_START.take(symbol), out=choice[FIRST_CLASS, :n])
        # A damaged block may decode to anything; it stays inside the tables until its checksum fails.
        ids = choice.take((_ROW_OF * lanes).take(symbol) + model.lane[:n]) & 0xFFFF
        at += bits
        np.minimum(at, last_bit[:n], out=at)
        np.minimum(used, last_word, out=used)
        np.maximum(width, 1 << SYMBOL_BITS, out=width)
        rows[step, :n] = ids
        model.compare(ids)
        model.learn(n, symbol, ids)
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * lanes
    for place, ids in enumerate(_transposed(rows)):
        out[order[place]] = ids[: lengths[place]]
    return out
