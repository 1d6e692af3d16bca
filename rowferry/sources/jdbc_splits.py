"""Parts of equal row counts, from counts that the database makes.

The range of the key is cut into buckets of one width and the database counts the rows of each. Buckets with
more rows than a part should have are cut again, all of them in one query a round, until they are light or a
single value. Neighbouring buckets are joined to parts; a heavy value is split by the modulus of a second column,
as are rows without a key. The parts are open at both ends, so they cover every row once whatever
is inserted meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

FINER = 16  # buckets for each part, so that parts differ by a sixteenth at most where values are spread
AGAIN = 64  # buckets that a heavy one is cut into
ROUNDS = 12  # enough for a range of 64 bits


@dataclass(frozen=True)
class Bucket:
    """Keys from ``low`` to below ``high``."""

    low: int
    high: int
    rows: int


def even_predicates(ask: Callable[[str], list[tuple]], columns: list[str], parts: int) -> list[str] | None:
    """Predicates that split the rows evenly; None where there is nothing to split.

    ``ask`` runs a select over ``{rows}`` and gives its rows; ``columns`` are quoted names, the key first."""
    key, others = columns[0], columns[1:]
    low, high, keyed, whole = ask(
        f"select min({key}) as lo, max({key}) as hi, count({key}) as keyed, count(*) as n from {{rows}} s")[0]
    if not whole:
        return None
    target = max(1, -(-whole // parts))
    found = []
    if keyed:
        found = _ranges(_buckets(ask, key, int(low), int(high), target, parts * FINER), key, others, target)
    if whole > keyed or not found:
        found += _split(f"{key} is null", others, whole - keyed, target)
    return found


def _cut(buckets: list[Bucket], pieces: int) -> list[tuple[Bucket, int]]:
    """Each bucket with the width of its pieces."""
    return [(b, max(1, -(-(b.high - b.low) // pieces))) for b in buckets]


def _buckets(ask, key: str, low: int, high: int, target: int, pieces: int) -> list[Bucket]:
    """Buckets in order: light, or one value wide."""
    done, heavy = [], [Bucket(low, high + 1, 0)]
    if low < 0 <= high:  # so that no difference leaves 64 bits
        heavy = [Bucket(low, 0, 0), Bucket(0, high + 1, 0)]
    for _ in range(ROUNDS):
        cut = _cut(heavy, pieces)
        place = " ".join(
            f"when {key} >= {b.low} and {key} < {b.high} then {k}" for k, (b, _) in enumerate(cut))
        offset = " ".join(
            f"when {key} >= {b.low} and {key} < {b.high} then floor(({key} - ({b.low}.0)) / {width})"
            for b, width in cut)
        rows = ask(
            f"select b, p, count(*) as n from (select case {place} else -1 end as b, case {offset} else -1 end as p from {{rows}} s) t "
            "where b >= 0 group by b, p")
        heavy = []
        for k, piece, count in rows:
            bucket, width = cut[int(k)]
            start = min(bucket.low + int(piece) * width, bucket.high - 1)
            part = Bucket(start, min(start + width, bucket.high), int(count))
            light = part.rows <= max(1, target // 4) or part.high - part.low == 1
            (done if light else heavy).append(part)
        if not heavy:
            break
        pieces = AGAIN
    return sorted([*done, *heavy], key=lambda b: b.low)


def _ranges(buckets: list[Bucket], key: str, others: list[str], target: int) -> list[str]:
    """A predicate per part."""
    groups: list[list[Bucket]] = []
    for bucket in buckets:
        rows = sum(b.rows for b in groups[-1]) if groups else 0
        if groups and rows + bucket.rows <= target + target // 8:
            groups[-1].append(bucket)
        else:
            groups.append([bucket])
    out = []
    for k, group in enumerate(groups):
        # a part reaches to where the next begins, the first and the last to the ends
        bounds = [f"{key} >= {group[0].low}"] if k else []
        bounds += [f"{key} < {groups[k + 1][0].low}"] if k + 1 < len(groups) else []
        out += _split(" and ".join(bounds) or f"{key} is not null", others, sum(b.rows for b in group), target)
    return out


def _split(where: str, others: list[str], rows: int, target: int) -> list[str]:
    """Parts of the rows that ``where`` names, by the modulus of a second column if they are too many for one."""
    parts = -(-rows // target)
    if parts < 2 or not others or rows <= target + target // 8:
        return [where]
    column = others[0]
    # a remainder has the sign of its number, and rows without a number go with the first part
    return [
        f"{where} and (abs(mod({column}, {parts})) = {k}" + (f" or {column} is null)" if k == 0 else ")")
        for k in range(parts)]
