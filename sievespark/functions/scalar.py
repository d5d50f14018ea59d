"""Column functions of the funnel; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns and thresholds of the funnel's file formats and stages.
SCORE_PATTERN = r"ENERGY=\s*(-?[\d.]+)"
#: What the score pattern finds beside numbers: two dots, or no digit. Casting those would throw once a row.
NO_NUMBER_PATTERN = r"\.[^.]*\.|^-?\.$"
VARIANT_SUFFIX = r"^(.*)_S\d+_T\d+$"
TAG_PATTERN = r"(?s)>\s*<(\w+)>[^\S\n]*\n(.*?)\n\n"
#: Critical value of a one-sided normal test at 0.05, as far as double precision tells them apart.
GOOD_T = -1.6448536269514726


def pose_score(block: Column) -> Column:
    """First score in a block, null if absent or not a number."""
    return F.nullif(F.regexp_extract(block, SCORE_PATTERN, 1), F.lit("")).try_cast("double")


def bad_score(block: Column) -> Column:
    """A score is there but is no number; null otherwise: its text."""
    text = F.regexp_extract(block, SCORE_PATTERN, 1)
    return F.when(text.rlike(NO_NUMBER_PATTERN), text)


def base_id(compound: Column) -> Column:
    """The id without its last stereo/tautomer suffix pair."""
    return F.regexp_replace(compound, VARIANT_SUFFIX, "$1")


def file_stem(path: Column) -> Column:
    """Name of a file without folder and last extension."""
    return F.regexp_replace(F.regexp_extract(F.url_decode(path), r"([^/]*)$", 1), r"\.[^.]*$", "")


def distance(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b)), F.lit(0.0)))


def minus(a: Column, b: Column) -> Column:
    return F.struct(*[(a[k] - b[k]).alias(k) for k in "xyz"])


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def cross(a: Column, b: Column) -> Column:
    pairs = (("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y"))
    return F.struct(*[(a[q] * b[r] - a[r] * b[q]).alias(p) for p, q, r in pairs])


def unit(a: Column) -> Column:
    size = F.sqrt(dot(a, a))
    return F.struct(*[(a[k] / size).alias(k) for k in "xyz"])


def dihedral(p1: Column, p2: Column, p3: Column, p4: Column) -> Column:
    """Signed angle in degrees around p2-p3; the points are structs of x, y, z."""
    b1, b2, b3 = minus(p2, p1), minus(p3, p2), minus(p4, p3)
    n2 = cross(b2, b3)
    return F.degrees(F.atan2(F.sqrt(dot(b2, b2)) * dot(b1, n2), dot(cross(b1, b2), n2)))


def angle_difference(a: Column, b: Column) -> Column:
    """a - b, wrapped into (-180, 180]."""
    d = F.pmod(a - b, F.lit(360.0))
    return F.when(d > 180, d - 360).otherwise(d)


def histogram_value(theta: Column, bins: Column) -> Column:
    """Linear interpolation in a 36-bin histogram of 10 degrees a bin; -180 falls in the last bin."""
    at = F.pmod(F.ceil(theta / 10).cast("int") + 17, F.lit(36))
    before = F.pmod(at + 35, F.lit(36))
    upper, lower = F.element_at(bins, at + 1), F.element_at(bins, before + 1)
    edge = (F.ceil(theta / 10) - 1) * 10.0
    return lower + (upper - lower) * (theta - edge) / 10.0


def quartic_strain(theta: Column, angles: Column) -> Column:
    """struct(energy, not_observed): the first peak within tolerance2 gives b1*d^2 + b2*d^4, none gives 100."""
    near = F.filter(angles, lambda a: F.abs(angle_difference(theta, a["theta_0"])) <= a["tolerance2"])
    peak = F.get(near, F.lit(0))
    d = angle_difference(theta, peak["theta_0"])  # the curves are given in degrees
    energy = F.when(peak.isNull(), 100.0).otherwise(peak["beta_1"] * d * d + peak["beta_2"] * F.pow(d, F.lit(4)))
    return F.struct(energy.alias("energy"), peak.isNull().alias("not_observed"))


def winner_first(blocks: Column, winner: Column) -> Column:
    """The array with element ``winner`` (from 0) in front, the others in order; unchanged if out of range."""
    inside = (winner >= 0) & (winner < F.size(blocks))
    moved = F.concat(F.slice(blocks, F.greatest(F.lit(0), winner) + 1, 1), F.slice(blocks, 1, F.greatest(F.lit(0), winner)), F.slice(blocks, F.greatest(F.lit(0), winner) + 2, F.size(blocks)))
    return F.when(inside, moved).otherwise(blocks)


def split_blocks(text: Column) -> Column:
    """Blocks that end in a line of $$$$; a tail that is not blank is a block, a blank one is none."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)(.*?\$\$\$\$(?:\r\n|\n)?|.+\z)"), F.lit(1))
    return F.filter(parts, lambda p: F.trim(F.regexp_replace(p, r"\s", "")) != "")


def property_map(block: Column) -> Column:
    """Tagged values of a block; the last of a repeated tag wins."""
    keys = F.regexp_extract_all(block, F.lit(TAG_PATTERN), F.lit(1))
    values = F.regexp_extract_all(block, F.lit(TAG_PATTERN), F.lit(2))

    def last(found: Column) -> Column:
        # Entries before a later entry of the same key fall out, so no map ever sees a key twice.
        kept = F.filter(found["k"], lambda k, i: F.array_position(F.slice(found["k"], i + 2, F.size(found["k"])), k) == 0)
        of = F.filter(found["v"], lambda v, i: F.array_position(F.slice(found["k"], i + 2, F.size(found["k"])), F.get(found["k"], i)) == 0)
        return F.map_from_arrays(kept, of)

    return F.when(block.isNotNull(), let(last, found=F.struct(keys.alias("k"), values.alias("v"))))


def add_properties(block: Column, properties: dict[str, Column]) -> Column:
    """The block with tags inserted before its last terminator."""
    body = F.regexp_replace(block, r"(?s)\$\$\$\$(?!.*\$\$\$\$).*\z", "")
    body = let(lambda b: F.concat(b, F.when(b.endswith("\n"), "").otherwise("\n")), b=body)
    tags = [x for name, value in properties.items() for x in (F.lit(f">  <{name}>\n"), F.coalesce(value.cast("string"), F.lit("")), F.lit("\n\n"))]
    return F.concat(body, *tags, F.lit("$$$$\n"))


def rounded(x: Column, digits: int) -> Column:
    """x at so many decimals as text formatting writes it: by its exact binary value, half to even.

    Spark's own rounding goes by the shortest decimal form (2.675 to 2.68, here 2.67). The product with
    10**digits is split into its double and what that leaves out, so a half is told exactly.
    """
    scale = 10.0**digits
    big = 134217729.0  # 2**27 + 1 parts a double into two halves
    high = lambda v: big * v - (big * v - v)
    a, b = high(x), high(F.lit(scale))
    p = x * scale
    lost = (a * b - p) + a * (scale - b) + (x - a) * b + (x - a) * (scale - b)
    n = F.floor(p).cast("double")
    over = (p - n - 0.5) + lost
    up = (over > 0) | ((over == 0) & (n % 2 != 0))
    # What is lost may also carry the value below n, never further.
    low = (p - n) + lost < -0.5
    return F.when(F.abs(x) < 2.0**52 / scale, (n + F.when(up, 1.0).when(low, -1.0).otherwise(0.0)) / scale).otherwise(x)


def normal_cdf(x: Column) -> Column:
    """P(Z <= x) to double precision, by the rational form of Hart (1968) as given by West (2005)."""
    a = F.abs(x)
    up = down = F.lit(0.0)
    for c in (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376):
        up = up * a + c
    for c in (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752):
        down = down * a + c
    far = a + 0.65
    for k in (4, 3, 2, 1):
        far = a + k / far
    tail = F.exp(-a * a / 2) * F.when(a < 7.07106781186547, up / down).otherwise(1 / far / 2.506628274631)
    return F.when(x > 0, 1 - tail).otherwise(tail)


def chunk_index(rank: Column, size: int) -> Column:
    """0-based chunk of a 1-based rank."""
    return F.expr("0").cast("long") + F.floor((rank - 1) / size)


def strained(total: Column, single: Column, flagged: Column, total_limit: float = 7.0, single_limit: float = 1.8) -> Column:
    """True, False, or null where the strain could not be scored."""
    return F.when(flagged | total.isNull() | single.isNull(), F.lit(None).cast("boolean")).otherwise((total >= total_limit) | (single >= single_limit))


def tier(count: Column, std_z: Column, t_stat: Column, loose: float = 1.0) -> Column:
    """singleton, loose, tier2 (consistent) or tier1 (consistent and significantly good)."""
    return F.when(count < 2, "singleton").when(std_z >= loose, "loose").when(t_stat <= GOOD_T, "tier1").otherwise("tier2")


def pdb_atom(serial: Column, name: Column, residue: Column, chain: Column, number: Column, x: Column, y: Column, z: Column, occupancy: Column, temperature: Column, element: Column) -> Column:
    """A fixed-column atom line; names below four letters start in the second column of their field."""
    field = F.when(F.length(name) < 4, F.concat(F.lit(" "), F.rpad(name, 3, " "))).otherwise(F.substring(name, 1, 4))
    form = "ATOM  %5d %s %s %s%4d    %8.3f%8.3f%8.3f%6.2f%6.2f          %2s"
    return F.format_string(form, serial, field, F.rpad(residue, 3, " "), chain, number, x, y, z, occupancy, temperature, element)


def let(body: Callable[..., Column], **values: Column) -> Column:
    """``body`` of values that are computed once each, however often it uses them."""
    one = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.element_at(F.transform(one, lambda r: body(*[r[k] for k in values])), 1)


def _product(a: Column, b: Column) -> Column:
    """(p, l): a * b as a double, and what that leaves out, exactly (Dekker)."""
    big = 134217729.0

    def halves(a: Column, b: Column, p: Column, u: Column, v: Column) -> Column:
        x, y = u - (u - a), v - (v - b)
        return F.struct(p.alias("p"), (((x * y - p) + x * (b - y) + (a - x) * y) + (a - x) * (b - y)).alias("l"))

    return let(halves, a=a, b=b, p=a * b, u=big * a, v=big * b)


def _side_of_half(x: Column, h: Column, e: Column) -> Column:
    """The sign of x - h * 10**e for positive x and whole h that are near each other; 0 beyond 10**44."""

    def compare(left: Column, right: Column, one: Column, two: Column, sign: Column) -> Column:
        def both(first: Column, by: Column) -> Column:
            def sums(p: Column, q: Column) -> Column:
                return F.signum(((p["p"] - right) + (p["l"] + q["p"])) + q["l"]) * sign

            return let(sums, p=_product(first["p"], by), q=_product(first["l"], by))

        return let(both, first=_product(left, one), by=two)

    power = lambda n: F.pow(F.lit(10.0), n)
    size = F.abs(e)
    found = let(compare, left=F.when(e < 0, x).otherwise(h), right=F.when(e < 0, h).otherwise(x), one=power(F.least(size, F.lit(22))), two=power(F.least(F.greatest(size - 22, F.lit(0)), F.lit(22))), sign=F.when(e < 0, 1).otherwise(-1))
    return F.when(size > 44, 0).otherwise(found)


def significant(x: Column, digits: int = 6) -> Column:
    """x with so many significant digits as ``%.6g`` and ``:g`` write it, trailing zeros left out.

    The shortest decimal form of a double lies on the same side of every shorter decimal as the
    double itself, so it decides the rounding, but for forms that end in the 5 of a half: there the
    exact value is compared, and exact halves go to the even digit. Exact for magnitudes from 1e-38
    to 1e29; a half beyond those goes to the even digit. Numbers below 2.3e-308, which a double holds
    in fewer digits, are given in their shortest form.
    """
    zero = F.lit("0")

    def parts(v: Column, s: Column) -> Column:
        """0.d times 10 to the point, d without zeros at its ends."""
        shift = F.when(F.contains(s, F.lit("E")), F.split_part(s, F.lit("E"), F.lit(2)).cast("int")).otherwise(0)
        mantissa = F.split_part(s, F.lit("E"), F.lit(1))
        whole, plain = F.split_part(mantissa, F.lit("."), F.lit(1)), F.replace(mantissa, F.lit("."), F.lit(""))
        return let(lambda v, plain, led, point: cut(v, F.rtrim(led, zero), point - F.length(plain) + F.length(led)), v=v, plain=plain, led=F.ltrim(plain, zero), point=F.length(whole) + shift)

    def cut(v: Column, d: Column, point: Column) -> Column:
        def rounded_(v: Column, d: Column, point: Column) -> Column:
            head, after = F.substring(d, 1, digits), F.substring(d, digits + 1, 1)
            side = _side_of_half(v, d.cast("double"), point - (digits + 1))
            up = F.when((F.length(d) == digits + 1) & (after == "5"), let(lambda side: (side > 0) | ((side == 0) & (F.substring(d, digits, 1).cast("int") % 2 == 1)), side=side)).otherwise((F.length(d) > digits) & (after >= "5"))
            return let(lambda n, point: written(F.when(n == 10**digits, F.lit("1")).otherwise(F.rtrim(n.cast("string"), zero)), point - 1 + (n == 10**digits).cast("int")), n=head.cast("long") + up.cast("long"), point=point)

        return let(rounded_, v=v, d=d, point=point)

    def written(r: Column, power: Column) -> Column:
        def form(r: Column, power: Column, size: Column) -> Column:
            dotted = lambda a, b: F.when(F.length(b) > 0, F.concat(a, F.lit("."), b)).otherwise(a)
            science = F.concat(dotted(F.substring(r, 1, 1), F.substring(r, 2, digits)), F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.when(F.length(size) < 2, F.concat(zero, size)).otherwise(size))
            large = dotted(F.rpad(F.substr(r, F.lit(1), power + 1), power + 1, zero), F.substr(r, power + 2, F.lit(digits)))
            small = F.concat(F.lit("0."), F.repeat(zero, F.greatest(F.lit(0), -power - 1)), r)
            return F.when((power < -4) | (power >= digits), science).when(power < 0, small).otherwise(large)

        return let(form, r=r, power=power, size=F.abs(power).cast("string"))

    body = F.when(F.abs(x) == float("inf"), F.lit("inf")).when(x == 0, zero).otherwise(let(parts, v=F.abs(x), s=F.abs(x).cast("string")))
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.when(F.isnan(x), F.lit("nan")).when(x.isNotNull(), F.concat(sign, body))
