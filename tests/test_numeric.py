"""Wide arithmetic against Python's integers; rates that aren't powers of ten in the voters view."""

import random
from decimal import Decimal, getcontext

from factbuilder import FactBuilder, ev
from pyspark.sql import functions as F

from govlake.functions.numeric import quotient, scaled_product

getcontext().prec = 300


def half_away(num, den):
    q, r = divmod(abs(num), abs(den))
    q += 2 * r >= abs(den)
    return q if (num < 0) == (den < 0) else -q


def scale_of(num, den):
    """Decimals of a NUMERIC quotient, from base 10,000 digits."""
    def digits(n):
        out = []
        while n:
            out.insert(0, n % 10_000)
            n //= 10_000
        return out or [0]
    a, b = digits(abs(num)), digits(abs(den))
    return max(16 - 4 * (len(a) - len(b) - (a[0] <= b[0])), 0)


def test_quotients(spark):
    rng = random.Random(1)
    pairs = [(1902587519026, 10**30), (1902587519026, 7), (1902587519026, 3 * 10**29 + 10**10), (1, 3), (2, 3), (0, 5), (5, 0), (-7, 2), (9999, 10000),
             (10**37, 1), (1, 10**37), (5, 10**38 - 1), (10**38 - 1, 3), (1, 9 * 10**36 + 1)]
    pairs += [(rng.randrange(10**rng.randint(1, 25)), rng.randrange(1, 10**rng.randint(1, 36))) for _ in range(300)]
    rows = spark.createDataFrame([(i, Decimal(a), Decimal(b)) for i, (a, b) in enumerate(pairs)], "i int, a decimal(38,0), b decimal(38,0)")
    for r in rows.select("i", quotient(F.col("a"), F.col("b")).alias("q")).collect():
        a, b = pairs[r["i"]]
        if b == 0:
            assert r["q"] is None
            continue
        scale = scale_of(a, b)
        want = half_away(a * 10**scale, b)
        if r["q"] is None:  # NULL only where a step has more than 38 digits
            assert len(str(abs(want))) > 38 or abs(b) > 10**37
        else:
            assert (r["q"]["scale"], int(r["q"]["q"])) == (scale, want), (a, b)


def test_products(spark):
    rng = random.Random(2)
    cases = [(rng.choice([1, -1]) * rng.randrange(10**rng.randint(1, 28)), rng.randrange(10**rng.randint(1, 30)), rng.randint(-18, 18)) for _ in range(500)]
    cases += [(10**37, 10, 0), (10**19, 10**19, 0), (0, 5, 3), (3, 5, -1), (-3, 5, -1), (5, 1, -1), (10**38 - 1, 1, 0), (7, 10**30, -30)]
    rows = spark.createDataFrame([(i, Decimal(a), Decimal(b), k) for i, (a, b, k) in enumerate(cases)], "i int, a decimal(38,0), b decimal(38,0), k int")
    misses = 0
    for r in rows.select("i", scaled_product(F.col("a"), F.col("b"), F.col("k")).alias("p")).collect():
        a, b, k = cases[r["i"]]
        want = half_away(a * b * 10**max(k, 0), 10**max(-k, 0))
        if r["p"] is None:
            assert abs(want) >= 10**38 or k < -18
            misses += abs(want) < 10**38
        else:
            assert int(r["p"]) == want, (a, b, k)
    assert misses <= 1


def _voter(fb, voter, sec):
    fb.call(f"reg-{voter}", "on_lockup_deployed", {"account_id": voter}, predecessor="v.hos.test", sec=sec,
            logs=[ev("lockup_deployed", account_id=voter)])
    fb.call(f"dep-{voter}", "storage_deposit", {"account_id": voter}, sec=sec, logs=[ev("ft_mint", owner_id=voter, amount="2345000000000000000000000")])


def test_rates_of_any_denominator(spark):
    """Three denominators: each voter has a row per rate, with the reward of NUMERIC, and nothing raises."""
    rates = [(1902587519026, 10**30), (19025875, 7), (1902587519026, 3 * 10**29 + 10**10), (1, 10**38 - 1), (5, 0)]
    fb = FactBuilder()
    for n, (num, den) in enumerate(rates):
        fb.call(f"new{n}", "new", {"venear_growth_config": {"annual_growth_rate_ns": {"numerator": str(num), "denominator": str(den)}}},
                signer="v.hos.test", sec=n)
    _voter(fb, "a.near", 100)
    got = sorted(fb.lake(spark).registered_voters().collect(), key=lambda r: r["extra_venear_on_principal"] or -1)
    seconds = 86400 * 365 - 100
    units, want = 2345, []
    for num, den in rates:
        if den in (0, 10**38 - 1):
            want.append(-1)
            continue
        scale = scale_of(num, den)
        value = half_away(units * seconds * 10**30 * half_away(num * 10**scale, den), 10**scale)
        want.append(value if value < 10**38 else -1)
    assert [int(r["extra_venear_on_principal"]) if r["extra_venear_on_principal"] is not None else -1 for r in got] == sorted(want)
    assert sum(w > 0 for w in want) == 2  # the second is beyond 38 digits: NULL, and counted by growth_config's flag
