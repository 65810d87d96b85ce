"""The hashes of samples in SQL, in 128-bit arithmetic, so that DuckDB can draw the same rows.

``hashed`` adds to a table the 64-bit xxHash of a seed and some integers, chained as Spark does; ``mixed`` the uniform
number of SplitMix64. Every step is a column of its own table, as an expression would repeat its operand.
"""

from __future__ import annotations

#: The primes of xxHash64, and the increment and multipliers of SplitMix64.
PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
GOLDEN, MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
WORD = "18446744073709551616::UHUGEINT"


def _times(a: str, b: int) -> str:
    return f"(({a})::UHUGEINT * {b}::UHUGEINT % {WORD})::UBIGINT"


def _plus(a: str, b: str) -> str:
    return f"((({a})::UHUGEINT + ({b})::UHUGEINT) % {WORD})::UBIGINT"


def _rotated(a: str, by: int) -> str:
    return f"((({a})::UHUGEINT * {2**by}::UHUGEINT) % {WORD} + ({a})::UHUGEINT // {2 ** (64 - by)}::UHUGEINT)::UBIGINT"


class _Steps:
    """A chain of tables, each with the columns of the one before and ``h`` (and ``k``) anew."""

    def __init__(self, table: str, name: str):
        self.table, self.name, self.parts = table, name, []

    def add(self, **columns: str) -> None:
        new = f"{self.name}_{len(self.parts)}"
        dropped = [c for c in columns if self.parts and c in self.known]
        self.known = (self.known if self.parts else set()) | set(columns)
        keep = f"* EXCLUDE ({', '.join(dropped)})" if dropped else "*"
        self.parts.append(f"{new} AS (SELECT {keep}, {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {self.table})")
        self.table = new

    def sql(self, out: str) -> str:
        return ", ".join([*self.parts, f"{self.name} AS (SELECT * EXCLUDE ({', '.join(sorted(self.known))}), {out} FROM {self.table})"])


def _unsigned(value: str) -> str:
    return f"(CASE WHEN {value} >= 0 THEN ({value})::UHUGEINT ELSE ({WORD} - (-({value})::HUGEINT)::UHUGEINT) END)::UBIGINT"


def _finish(steps: _Steps) -> None:
    for by, prime in ((33, PRIMES[1]), (29, PRIMES[2])):
        steps.add(h=f"xor(h, h >> {by})")
        steps.add(h=_times("h", prime))
    steps.add(h="xor(h, h >> 32)")


def _seeded(table: str, name: str, seed: int) -> _Steps:
    p1, p2, p3, _, p5 = PRIMES
    steps = _Steps(table, name)
    steps.add(h=f"xor({(42 + p5 + 4) % 2**64}::UBIGINT, {_times(str(seed), p1)})")
    steps.add(h=_plus(_times(_rotated("h", 23), p2), str(p3)))
    _finish(steps)
    return steps


def _word(steps: _Steps, value: str) -> None:
    p1, p2, _, p4, _ = PRIMES
    steps.add(k=_times(value, p2))
    steps.add(k=_times(_rotated("k", 31), p1))
    steps.add(h="xor(h, k)")
    steps.add(h=_plus(_times(_rotated("h", 27), p1), str(p4)))


def hashed_text(table: str, name: str, seed: int, column: str, length: int) -> str:
    """CTEs ending in ``name``: ``table`` with the hash ``h`` of a 32-bit seed and an ASCII text of ``length`` < 32."""
    p1, _, _, _, p5 = PRIMES
    steps = _seeded(table, name, seed)
    steps.add(h=_plus("h", str((p5 + length) % 2**64)))
    byte = lambda i: f"ascii(substr({column}, {i + 1}, 1))::UHUGEINT"
    for at in range(0, length - 7, 8):
        _word(steps, f"({' + '.join(f'{byte(at + i)} * {256**i}::UHUGEINT' for i in range(8))})::UBIGINT")
    if length % 8 > 3:
        raise ValueError("lengths that leave at most three bytes")
    for at in range(length - length % 8, length):
        steps.add(h=f"xor(h, {_times(byte(at), p5)})")
        steps.add(h=_times(_rotated("h", 11), p1))
    _finish(steps)
    steps.add(k="h")
    return ", ".join([*steps.parts, f"{name} AS (SELECT * EXCLUDE (k) FROM {steps.table})"])


def hashed(table: str, name: str, seed: int, *longs: str) -> str:
    """CTEs ending in ``name``: ``table`` with ``u`` in [0, 1), from the hash of a 32-bit seed and 64-bit columns."""
    steps = _seeded(table, name, seed)
    for column in longs:
        steps.add(h=_plus("h", str((PRIMES[4] + 8) % 2**64)))
        _word(steps, _unsigned(column))
        _finish(steps)
    return steps.sql(f"(h >> 11)::DOUBLE / {2**53}::DOUBLE AS u")


def mixed(table: str, name: str, salt: str, offset: str) -> str:
    """CTEs ending in ``name``: ``table`` with ``u``, the uniform number of SplitMix64 at an offset behind a salt."""
    steps = _Steps(table, name)
    steps.add(h=_plus(_plus(salt, _unsigned(offset)), str(GOLDEN)))
    for by, factor in zip((30, 27), MIX):
        steps.add(h=f"xor(h, h >> {by})")
        steps.add(h=_times("h", factor))
    steps.add(h="xor(h, h >> 31)")
    return steps.sql(f"(h >> 11)::DOUBLE / {2**53}::DOUBLE AS u")
