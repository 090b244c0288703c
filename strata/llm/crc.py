"""CRC-32 of joined parts from the CRCs of the parts, for whole arrays at once.

The CRC of A followed by B is the CRC of A, carried over as many zero bytes as B has, exclusive-or the CRC of B. Carrying is linear in
the CRC's bits: for each number of bytes four tables of 256 entries do it, one for each byte of the CRC.
"""

from functools import lru_cache

import numpy as np

POLYNOMIAL = 0xEDB88320  # fixed value of CRC-32, bits reversed


@lru_cache(1)
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _by_table(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """crc through one set of tables (4 x 256)."""
    out = tables[0][crc & np.uint32(255)]
    for byte in (1, 2, 3):
        out = out ^ tables[byte][(crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


@lru_cache(8)
def carry_tables(most: int) -> np.ndarray:
    """Tables for 0 to `most` bytes: (most + 1) x 4 x 256."""
    single = np.arange(256, dtype=np.uint32)
    tables = [np.stack([single << np.uint32(8 * byte) for byte in range(4)])]
    for _ in range(most):
        last = tables[-1]
        tables.append(_byte_table()[last & np.uint32(255)] ^ (last >> np.uint32(8)))
    return np.stack(tables)


def carried(crc: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
    """Each CRC carried over its own number of bytes, at most `most`."""
    tables = carry_tables(most)
    out = tables[lengths, 0, crc & np.uint32(255)]
    for byte in (1, 2, 3):
        out = out ^ tables[lengths, byte, (crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


@lru_cache(64)
def _power_tables(power: int) -> np.ndarray:
    """Tables for 2**power bytes, by squaring."""
    if power == 0:
        return carry_tables(1)[1]
    half = _power_tables(power - 1)
    return np.stack([_by_table(half, half[byte]) for byte in range(4)])


def carried_far(crc: int, length: int) -> int:
    """One CRC over any number of bytes."""
    value, power = np.array([crc], np.uint32), 0
    while length:
        if length & 1:
            value = _by_table(_power_tables(power), value)
        length >>= 1
        power += 1
    return int(value[0])
