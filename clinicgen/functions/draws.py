"""Seeded draws as native Spark SQL expressions.

Every random value is a pure function of ``(seed, label, key...)``: the first
52 bits of a SHA-256 digest, scaled to [0, 1). A row's draws therefore do not
depend on partitioning, task retries or executor loss, and an independent SQL
engine computes the same numbers. One digest yields up to four uniforms
(``slot`` 0..3); Catalyst evaluates a digest shared by several slots once.

The helpers build SQL *text* (arguments are SQL snippets: column names,
expressions or Python numbers) so a whole projection reaches the JVM in one
``selectExpr`` call; ``col()`` wraps a snippet as a Column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO52 = 4503599627370496.0  # 2**52: a 13-hex-digit prefix scaled to [0, 1)
TWO_PI = 2.0 * math.pi

Sql = str | int | float


def col(expr: str) -> Column:
    return F.expr(expr)


def s(x: Sql) -> str:
    """SQL text of a snippet or Python number (doubles as exact literals)."""
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, int):
        return str(x)
    if isinstance(x, float):
        r = repr(x)
        return f"CAST('{r}' AS DOUBLE)" if ("e" in r or "inf" in r or "nan" in r) else f"{r}D"
    return f"({x})"


def lit_str(v: str | None) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def str_array(values: Sequence[str | None]) -> str:
    """A constant array<string> (NULL elements allowed); folded to a literal."""
    return "array(" + ", ".join(lit_str(v) for v in values) + ")"


def digest(seed: int, label: str, *keys: Sql) -> str:
    """Hex SHA-256 of ``seed|label|key1|key2...`` (keys as their string form)."""
    ks = ", ".join(f"CAST({s(k)} AS STRING)" for k in keys)
    return f"sha2(concat_ws('|', '{seed}', {lit_str(label)}, {ks}), 256)"


def u(seed: int, label: str, *keys: Sql, slot: int = 0) -> str:
    """Uniform double in [0, 1) for ``(seed, label, keys)`` (2.4.1)."""
    if not 0 <= slot <= 3:
        raise ValueError("slot must be in 0..3 (four 52-bit draws per digest)")
    return f"(CAST(conv(substring({digest(seed, label, *keys)}, {1 + 13 * slot}, 13), 16, 10) AS BIGINT) / {s(TWO52)})"


def draw_int(uc: str, lo: Sql, hi: Sql) -> str:
    """Uniform integer in [lo, hi], both inclusive (2.4.2)."""
    return f"CAST({s(lo)} + floor({uc} * ({s(hi)} - {s(lo)} + 1)) AS BIGINT)"


def draw_element(uc: str, arr: Sql | Sequence[str | None]) -> str:
    """Uniform element of an array expression or a Python list (2.4.3)."""
    a = str_array(arr) if isinstance(arr, (list, tuple)) else s(arr)
    return f"element_at({a}, CAST(floor({uc} * size({a})) + 1 AS INT))"


def cumulative_bounds(weights: Sequence[tuple[str | None, float]]) -> list[tuple[str | None, float]]:
    """(value, upper bound) with bounds normalised by the weight sum."""
    total = float(sum(w for _, w in weights))
    if total <= 0:
        raise ValueError("weights must sum to a positive number")
    out, acc = [], 0.0
    for v, w in weights:
        acc += float(w)
        out.append((v, acc / total))
    return out


def weighted_choice(uc: str, weights: Sequence[tuple[str | None, float]]) -> str:
    """Category by cumulative weight; a ``None`` category yields NULL (2.4.4).

    ``u < bound_i`` picks category i; the last category takes the rest, so
    rounding of the bounds never drops a row.
    """
    b = cumulative_bounds(weights)
    whens = " ".join(f"WHEN {uc} < {s(x)} THEN {lit_str(v)}" for v, x in b[:-1])
    return f"CAST(CASE {whens} ELSE {lit_str(b[-1][0])} END AS STRING)"


def bernoulli(uc: str, pct: float) -> str:
    """True with probability ``pct`` percent (2.4.5)."""
    return f"({uc} < {s(pct / 100.0)})"


def std_normal(u1: str, u2: str) -> str:
    """Box-Muller standard normal from two uniforms."""
    return f"(sqrt({s(-2.0)} * ln({s(1.0)} - {u1})) * cos({s(TWO_PI)} * {u2}))"


def _normal_mass(a: float, b: float) -> float:
    """P(a < Z < b) of a standard normal, from the tail nearer to the interval."""
    if a > 0:
        return 0.5 * (math.erfc(a / math.sqrt(2)) - math.erfc(b / math.sqrt(2)))
    if b < 0:
        return 0.5 * (math.erfc(-b / math.sqrt(2)) - math.erfc(-a / math.sqrt(2)))
    return 0.5 * (math.erf(b / math.sqrt(2)) - math.erf(a / math.sqrt(2)))


def trunc_normal_bounds(mean: float, sd: float, lo: int, hi: int) -> list[float]:
    """Cumulative probabilities of lo..hi-1 under "``int(N(mean, sd))`` redrawn until in [lo, hi]".

    ``int()`` truncates toward zero, so 0 stands for the open interval (-1, 1).
    """
    if lo > hi:
        raise ValueError("lo > hi")
    ends = [(v if v > 0 else v - 1, v + 1 if v >= 0 else v) for v in range(lo, hi + 1)]
    mass = [_normal_mass((a - mean) / sd, (b - mean) / sd) for a, b in ends]
    total = math.fsum(mass)
    if total <= 0.0:
        raise ValueError(f"N({mean}, {sd}) has no mass in [{lo}, {hi}] that a double can tell")
    return [math.fsum(mass[:i]) / total for i in range(1, len(mass))]


GUIDE = 512  # equal slices of the uniform


def guide_table(bounds: list[float], size: int = GUIDE) -> tuple[list[int], list[int]]:
    """Per slice [i/size, (i+1)/size) of the uniform, how many bounds lie at or below its start, and how many inside it."""
    below = [sum(b <= i / size for b in bounds) for i in range(size + 1)]
    return below[:-1], [hi - lo for lo, hi in zip(below, below[1:], strict=False)]


def trunc_normal_int(seed: int, label: str, key: Sql, mean: float, sd: float, lo: int, hi: int) -> str:
    """``int(N(mean, sd))`` redrawn until in [lo, hi] (2.4.6), from its exact discrete law.

    One uniform is inverted by a guide table: its slice gives the first value that is possible and one comparison with the next bound decides, in slices
    that hold at most one. Slices with more (in the tails) search all bounds. All tables are constants of the plan.
    """
    bounds = trunc_normal_bounds(mean, sd, lo, hi)
    if not bounds:
        return f"CAST({lo} AS BIGINT)"
    array = "array(" + ", ".join(s(x) for x in bounds) + ")"
    below, inside = guide_table(bounds)
    draw, n = u(seed, label, key), len(bounds)
    # per slice: lo + bounds below, and the bound to compare with (2 where none is left: a uniform is below 1); NULL asks for the search
    first = "array(" + ", ".join(str(lo + k) if m < 2 else "NULL" for k, m in zip(below, inside, strict=True)) + ")"
    following = "array(" + ", ".join(s(bounds[k]) if k < n else s(2.0) for k in below) + ")"
    at = f"CAST(floor({draw} * {s(float(GUIDE))}) AS INT)"
    return (f"CAST(coalesce({first}[{at}] + CASE WHEN {following}[{at}] <= {draw} THEN 1 ELSE 0 END, "
            f"{lo} + size(filter({array}, b -> b <= {draw}))) AS BIGINT)")


def folded_normal_int(u1: str, u2: str, mean: Sql, sd: float) -> str:
    """``|int(N(mean, sd))|`` (2.4.7)."""
    return f"abs(CAST(CAST({s(mean)} AS DOUBLE) + {s(float(sd))} * {std_normal(u1, u2)} AS BIGINT))"


def exp_clipped(uc: str, mean: float, cap: float) -> str:
    """Exponential with the given mean, clipped above at ``cap`` (2.4.8)."""
    return f"least({s(-float(mean))} * ln({s(1.0)} - {uc}), {s(float(cap))})"


def exp_clipped_ms(uc: str, mean: float, cap: float, unit_ms: int) -> str:
    """Clipped exponential in whole milliseconds (unit_ms = ms per unit of mean)."""
    return f"CAST(floor({exp_clipped(uc, mean, cap)} * {s(float(unit_ms))}) AS BIGINT)"


def draw_date(uc: str, lo: Sql, hi: Sql) -> str:
    """Uniform date in [lo, hi] (2.4.9)."""
    return f"date_add({s(lo)}, CAST(floor({uc} * (datediff({s(hi)}, {s(lo)}) + 1)) AS INT))"


def draw_timestamp(uc: str, lo: Sql, hi: Sql) -> str:
    """Uniform timestamp in [lo, hi] at whole-second offsets from ``lo`` (2.4.10)."""
    return f"timestampadd(SECOND, CAST(floor({uc} * (timestampdiff(SECOND, {s(lo)}, {s(hi)}) + 1)) AS BIGINT), {s(lo)})"


def draw_two_distinct(u1: str, u2: str, u3: str, arr: Sql | Sequence[str | None], pct_second: float) -> tuple[str, str]:
    """Main element, and with ``pct_second`` % a second one from the rest (2.4.13).

    The second is NULL when not drawn or when nothing is left.
    """
    a = str_array(arr) if isinstance(arr, (list, tuple)) else s(arr)
    first = draw_element(u1, a)
    rest = f"array_remove({a}, {first})"
    second = f"CASE WHEN size({rest}) > 0 AND {bernoulli(u2, pct_second)} THEN {draw_element(u3, rest)} END"
    return first, second


def random_digits(uc: str, digits: Sql) -> str:
    """Random number with up to ``digits`` digits, as text without padding (2.4.15)."""
    return f"CAST(CAST(floor({uc} * pow({s(10.0)}, CAST({s(digits)} AS DOUBLE))) AS BIGINT) AS STRING)"


def passport_number(u1: str, u2: str) -> str:
    """Passport-like id: one capital letter and eight digits (own format)."""
    return f"concat(char(CAST(65 + floor({u1} * 26) AS BIGINT)), lpad(CAST(CAST(floor({u2} * {s(1e8)}) AS BIGINT) AS STRING), 8, '0'))"
