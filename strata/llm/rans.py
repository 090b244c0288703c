"""Static range asymmetric numeral system over blocks of symbols, for numpy arrays.

A block's symbols are dealt to LANES states in turn, and the states of many blocks are moved on together. States are 64 bits and give off 32
bits at a time. After each STEPS rounds the states and the place in the words are noted: from such a checkpoint a decoder can start, and
all segments between checkpoints are decoded at the same time. A block of bytes is complete in itself but for the frequency table:

    4s magic, u16 lanes, u16 steps, u32 symbols, u32 segments, u32 words, u32 CRC-32 of the symbols as unsigned 32-bit integers,
    segments x u32 first word of each segment, segments x lanes x u64 states, words x u32, u32 CRC-32 of all the bytes before
"""

import struct
import zlib

import numpy as np

SCALE = 20  # frequencies sum to 2**SCALE
LANES, STEPS = 32, 256
BLOCK = 16 * LANES * STEPS
MAGIC = b"TKR1"
HEADER = struct.Struct("<4sHHIIII")
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
SCALED = np.uint64(SCALE)


class Damaged(ValueError):
    """A block whose bytes or symbols do not meet its checksums."""


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts as parts of 2**SCALE: at least 1 for each symbol that occurs, the rest in proportion, remainders to the largest."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    if len(used) > 1 << SCALE:
        raise ValueError("more symbols than the scale has parts")
    share = counts[used].astype(float) / float(counts[used].sum()) * ((1 << SCALE) - len(used))
    whole = np.floor(share).astype(np.int64)
    left = (1 << SCALE) - len(used) - int(whole.sum())
    order = np.argsort(-(share - whole), kind="stable")
    whole += left // len(used)
    whole[order[: left % len(used)]] += 1
    out[used] = whole + 1
    return out


class Table:
    """The shared table: frequency and lower bound of each symbol, and the symbol of each part."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(np.uint64)
        self.below = np.concatenate(([0], np.cumsum(frequency)))[:-1].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)
        self.filler = int(np.argmax(frequency)) if len(frequency) else 0


def encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """Each block as bytes. Blocks that need equally many rounds are encoded together."""
    out: list[bytes] = [b""] * len(blocks)
    by_rounds: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        by_rounds.setdefault(-(-len(block) // (LANES * STEPS)) * STEPS, []).append(i)
    for rounds, some in by_rounds.items():
        for i, data in zip(some, _encode_equal([blocks[i] for i in some], rounds, table)):
            out[i] = data
    return out


def _encode_equal(blocks: list[np.ndarray], rounds: int, table: Table) -> list[bytes]:
    symbols = np.full((len(blocks), rounds * LANES), table.filler, np.int64)
    for i, block in enumerate(blocks):
        symbols[i, : len(block)] = block
    symbols = symbols.reshape(len(blocks), rounds, LANES).transpose(1, 0, 2)
    frequency, below = table.frequency[symbols], table.below[symbols]
    state = np.full((len(blocks), LANES), LOW, np.uint64)
    full = np.empty(symbols.shape, bool)
    words = np.empty(symbols.shape, np.uint32)
    noted = np.empty((rounds // STEPS, len(blocks), LANES), np.uint64)
    room = np.uint64(63 - SCALE)
    for t in range(rounds - 1, -1, -1):
        f = frequency[t]
        gives = np.greater_equal(state, f << room, out=full[t])
        words[t] = state  # the lower 32 bits
        state = np.where(gives, state >> WORD, state)
        quotient = state // f
        state = (quotient << SCALED) + (state - quotient * f) + below[t]
        if t % STEPS == 0:
            noted[t // STEPS] = state
    out = []
    for i, block in enumerate(blocks):
        given = full[:, i]
        stream = words[:, i][given]
        first = np.concatenate(([0], np.cumsum(given.sum(axis=1))[STEPS - 1 :: STEPS]))[: rounds // STEPS]
        head = HEADER.pack(MAGIC, LANES, STEPS, len(block), rounds // STEPS, len(stream), zlib.crc32(block.astype("<u4").tobytes()))
        data = head + first.astype("<u4").tobytes() + noted[:, i].astype("<u8").tobytes() + stream.astype("<u4").tobytes()
        out.append(data + struct.pack("<I", zlib.crc32(data)))
    return out


def _opened(data: bytes) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, CRC of the symbols, first words, states and words of a block that meets its checksum."""
    if len(data) < HEADER.size + 4 or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise Damaged("bytes of a token block do not meet their checksum")
    magic, lanes, steps, n, segments, n_words, crc = HEADER.unpack_from(data)
    if (magic, lanes, steps) != (MAGIC, LANES, STEPS):
        raise Damaged("not a token block of this format")
    at = HEADER.size
    first = np.frombuffer(data, "<u4", segments, at)
    states = np.frombuffer(data, "<u8", segments * LANES, at + 4 * segments).reshape(segments, LANES)
    return n, crc, first, states, np.frombuffer(data, "<u4", n_words, at + 4 * segments + 8 * segments * LANES)


def _segments(state: np.ndarray, place: np.ndarray, words: np.ndarray, table: Table) -> np.ndarray:
    """All segments from their states and first words: a row of symbols for each."""
    out = np.empty((STEPS, *state.shape), np.uint32)
    part, wide = np.uint64((1 << SCALE) - 1), len(words) - 1
    place = place[:, None] - 1
    for t in range(STEPS):
        slot = state & part
        symbol = np.take(table.symbol, slot.view(np.int64), out=out[t])
        state >>= SCALED
        state *= np.take(table.frequency, symbol)
        state += slot
        state -= np.take(table.below, symbol)
        needs = state < LOW
        taken = np.cumsum(needs, axis=1)
        taken += place
        place = taken[:, -1:].copy()
        np.minimum(taken, wide, out=taken)
        state = np.where(needs, (state << WORD) | words[taken], state)
    return out.transpose(1, 0, 2).reshape(state.shape[0], -1)


def decode(blocks: list[bytes], table: Table) -> list[np.ndarray]:
    """The symbols of whole blocks, decoded together and held to both checksums."""
    parts = [_opened(data) for data in blocks]
    if not parts:
        return []
    begins = np.cumsum([0] + [len(p[4]) for p in parts])
    place = np.concatenate([p[2].astype(np.int64) + b for p, b in zip(parts, begins)])
    words = np.concatenate([*[p[4] for p in parts], np.zeros(1, np.uint32)])
    rows = _segments(np.concatenate([p[3] for p in parts]).astype(np.uint64), place, words, table)
    out, at = [], 0
    for n, crc, first, _, _ in parts:
        symbols = rows[at : at + len(first)].reshape(-1)[:n]
        at += len(first)
        if zlib.crc32(np.ascontiguousarray(symbols, "<u4")) != crc:
            raise Damaged("symbols of a token block do not meet their checksum")
        out.append(symbols)
    return out


def decode_range(data: bytes, table: Table, first: int, last: int) -> np.ndarray:
    """Symbols `first` to `last` (exclusive) of a block: only the segments between the checkpoints around them are decoded."""
    n, _, starts, states, words = _opened(data)
    last, span = min(last, n), LANES * STEPS
    if last <= first:
        return np.empty(0, np.uint32)
    begin, end = first // span, -(-last // span)
    rows = _segments(states[begin:end].astype(np.uint64), starts[begin:end].astype(np.int64), np.append(words, np.uint32(0)), table)
    return rows.reshape(-1)[first - begin * span : last - begin * span]
