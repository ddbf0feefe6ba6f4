"""keccak-256, for the few texts that name event types. It runs on the driver, once per type, never on rows."""

from __future__ import annotations

LANES = 25
RATE = 136  # bytes of a 1,600-bit state that take input, for a digest of 256 bits
ROUNDS = 24
ALL = (1 << 64) - 1


def _round_constants() -> list[int]:
    """One constant per round: the bits at places 2^j - 1 come from a shift register of eight bits."""
    register, out = 1, []
    for _ in range(ROUNDS):
        constant = 0
        for j in range(7):
            constant |= (register & 1) << ((1 << j) - 1)
            register = (register << 1) ^ (0x171 if register >> 7 else 0)
        out.append(constant)
    return out


def _lane_moves() -> list[tuple[int, int, int]]:
    """(from, to, rotation) of every lane but the first, along the walk (x, y) -> (y, 2x + 3y)."""
    x, y, out = 1, 0, []
    for step in range(LANES - 1):
        x_next, y_next = y, (2 * x + 3 * y) % 5
        out.append((x + 5 * y, y + 5 * y_next, (step + 1) * (step + 2) // 2 % 64))
        x, y = x_next, y_next
    return out


CONSTANTS, MOVES = _round_constants(), _lane_moves()


def _turned(lane: int, by: int) -> int:
    return (lane << by | lane >> (64 - by)) & ALL


def permuted(state: list[int]) -> list[int]:
    """The state of 25 lanes after all rounds."""
    for constant in CONSTANTS:
        column = [state[x] ^ state[x + 5] ^ state[x + 10] ^ state[x + 15] ^ state[x + 20] for x in range(5)]
        mixed = [lane ^ column[(i + 4) % 5] ^ _turned(column[(i + 1) % 5], 1) for i, lane in enumerate(state)]
        moved = [mixed[0]] * LANES
        for source, to, by in MOVES:
            moved[to] = _turned(mixed[source], by)
        state = [
            lane ^ (~moved[i - i % 5 + (i + 1) % 5] & moved[i - i % 5 + (i + 2) % 5]) for i, lane in enumerate(moved)
        ]
        state[0] ^= constant
    return state


def sponge(data: bytes, ending: int) -> bytes:
    """32 bytes of digest; `ending` is the byte that starts the padding."""
    padded = bytearray(data) + bytes([ending]) + bytes(-(len(data) + 1) % RATE)
    padded[-1] |= 0x80
    state = [0] * LANES
    for at in range(0, len(padded), RATE):
        for i in range(RATE // 8):
            state[i] ^= int.from_bytes(padded[at + 8 * i : at + 8 * i + 8], "little")
        state = permuted(state)
    return b"".join(lane.to_bytes(8, "little") for lane in state[:4])


def keccak256(data: bytes) -> bytes:
    return sponge(data, 0x01)
