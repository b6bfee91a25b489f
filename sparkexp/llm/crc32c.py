"""CRC-32C of many byte strings at once, and the mask that record files use."""

from __future__ import annotations

import numpy as np

# Fixed values of the public record format.
_POLYNOMIAL = 0x82F63B78
_MASK_DELTA = 0xA282EAD8
_CHUNK = 128


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_TABLE = _byte_table()


def _word_tables() -> list[np.ndarray]:
    """What a state of one byte becomes after that byte and 0, 1, 2 or 3 zero bytes more."""
    tables = [_TABLE]
    for _ in range(3):
        tables.append(_TABLE[tables[-1] & 255] ^ (tables[-1] >> 8))
    return tables


_WORDS = _word_tables()


def _zeros_tables(count: int) -> np.ndarray:
    """What ``count`` zero bytes make of each byte of a state."""
    state = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(count):
        state = _TABLE[state & 255] ^ (state >> 8)
    return state.reshape(4, 256)


_ZEROS = _zeros_tables(_CHUNK)


def crc32c(parts: list[bytes]) -> np.ndarray:
    """The checksum of each part; a part has four bytes at least.

    Zero bytes in front do not change a state of zero, so each part is padded in
    front to whole chunks, all chunks are summed side by side, and the chunks of
    a part are then joined from left to right.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    if not len(sizes):
        return np.empty(0, np.uint32)
    if sizes.min() < 4:
        raise ValueError("A part for a checksum has fewer than four bytes.")
    chunks = -(-sizes // _CHUNK)
    ends = np.cumsum(chunks)
    flat = np.zeros(int(ends[-1]) * _CHUNK, np.uint8)
    for part, end, size in zip(parts, (ends * _CHUNK).tolist(), sizes.tolist()):
        flat[end - size : end] = np.frombuffer(part, np.uint8)
        flat[end - size : end - size + 4] ^= 255
    words = np.ascontiguousarray(flat.view("<u4").reshape(-1, _CHUNK // 4).T)
    state, one = np.zeros(words.shape[1], "<u4"), np.empty(words.shape[1], np.uint32)
    for word in words:  # four bytes at a time
        first, second, third, fourth = (state ^ word).view(np.uint8).reshape(-1, 4).T
        state = np.take(_WORDS[3], first)
        for table, byte in ((_WORDS[2], second), (_WORDS[1], third), (_WORDS[0], fourth)):
            state ^= np.take(table, byte, out=one, mode="clip")
    order = np.argsort(-chunks, kind="stable")
    firsts, counts = (ends - chunks)[order], chunks[order]
    total = state[firsts]
    for k in range(1, int(counts[0])):
        n = int(np.searchsorted(-counts, -k, side="left"))  # parts with more than k chunks
        t = total[:n]
        moved = _ZEROS[0][t & 255] ^ _ZEROS[1][t >> 8 & 255] ^ _ZEROS[2][t >> 16 & 255] ^ _ZEROS[3][t >> 24]
        total[:n] = moved ^ state[firsts[:n] + k]
    out = np.empty(len(parts), np.uint32)
    out[order] = total
    return ~out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum of data with checksums in it stays sound."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK_DELTA)
