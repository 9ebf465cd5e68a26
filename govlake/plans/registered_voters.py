"""V5 registered_voters: first registration (with a deposit) per voter, power and rewards.

Stages (each a DataFrame): growth config, first registration, first deposit,
latest lock balance, participation in the ten most recent approvals, latest
active delegation, reward on principal, one-hop delegated sums.

Reward maths is exact integer arithmetic in DECIMAL(38,0):
  floor(P / 1e21) * 1e21 * (num / den) * (floor(now_ns/1e9) - floor(t_ns/1e9)) * 1e9
  = (P div 1e21) * seconds * q * 10^(30 - scale)
where q / 10^scale is the quotient as NUMERIC rounds it (``functions.numeric``). The quotient is taken once a
rate, the product is made of two limbs a number; a reward of more than 38 digits is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.functions.json import jnum, jstr
from govlake.functions.numeric import quotient, scaled_product
from govlake.functions.time import epoch_ns, floor_div
from govlake.operators.decode import calls, successful
from govlake.plans.common import on_contracts

METHODS = ["new", "storage_deposit", "on_lockup_update", "on_lockup_deployed"]
TEN_POW_21 = 10 ** 21
TEN_POW_9 = 10 ** 9
TEN_POW_30 = 10 ** 30  # the contract's denominator
RECENT_APPROVALS = 10

COLUMNS = ["id", "receipt_id", "registered_date", "registered_at", "registered_voter_id", "hos_contract_address",
           "has_locked_unlocked_near", "is_actively_delegating", "delegatee_id", "proposal_participation_rate",
           "voting_power_from_locks_unlocks", "initial_voting_power", "principal_balance",
           "extra_venear_on_principal", "voting_power_from_delegations", "delegated_extra_venear",
           "current_voting_power", "block_height", "block_hash"]


def _base(silver, cfg):
    return successful(calls(silver, METHODS)).where(on_contracts(cfg))


def growth_config(silver: DataFrame, cfg: ContractConfig) -> DataFrame:
    """Growth rate per contract from `new` calls (not de-duplicated, as in the reference)."""
    g = "$.venear_growth_config.annual_growth_rate_ns"
    return _base(silver, cfg).where(F.col("method_name") == "new").select(
        F.col("signer_account_id").alias("gc_contract"),
        jnum(F.col("args"), f"{g}.numerator").alias("growth_rate_numerator_ns"),
        jnum(F.col("args"), f"{g}.denominator").alias("growth_rate_denominator_ns"),
    ).withColumn("exact_quotient", _divides(F.col("growth_rate_denominator_ns")))


def _divides(den: F.Column) -> F.Column:
    """Whether 10^30 is a multiple of the denominator; the quotient of other rates is rounded, which this column flags."""
    ten30 = F.lit(str(TEN_POW_30)).cast("decimal(38,0)")
    return F.when(den != 0, F.pmod(ten30, den.cast("decimal(38,0)")) == 0)


def _growth_by_contract(silver: DataFrame, cfg: ContractConfig) -> DataFrame:
    """The different rates of each view contract with how often each was given, as one row a contract.

    Voters of one contract share a join key: AQE broadcasts these few rows by their measured size, which keeps the voters where they
    are. The list holds a contract's different rates, not its calls.
    """
    rates = growth_config(silver, cfg).where(F.col("gc_contract").isin(*cfg.view_contracts))
    num, den = F.col("growth_rate_numerator_ns"), F.col("growth_rate_denominator_ns")
    each = rates.groupBy("gc_contract", num, den).agg(F.count(F.lit(1)).cast("int").alias("times")).withColumn("growth_quotient", quotient(num, den))
    return each.groupBy("gc_contract").agg(F.collect_list(F.struct(num, den, "growth_quotient", "times")).alias("rates"))


REG, DEP, LOCK = "on_lockup_deployed", "storage_deposit", "on_lockup_update"


def voter_events(silver: DataFrame, cfg: ContractConfig) -> DataFrame:
    """W3-W5 in ONE scan and ONE shuffle: per voter the first registration, the first
    deposit and the latest lock update.

    Each is the min (or max) of a struct ordered (time, receipt, payload) taken
    over that method's rows only; these are partial aggregates, so a voter with
    very many events sends one row per map task. Registration and deposit need
    their own key / amount (DISTINCT ON inputs); rows without a voter keep a
    NULL group that never joins, as in the reference.
    """
    m, lg, a = F.col("method_name"), F.col("log0"), F.col("args")
    voter = (F.when(m == REG, F.coalesce(jstr(lg, "$.data[0].account_id"), jstr(a, "$.account_id")))
             .when(m == DEP, F.coalesce(jstr(lg, "$.data[0].owner_id"), jstr(a, "$.account_id")))
             .otherwise(jstr(lg, "$.data[0].account_id")))
    amount = F.when(m == DEP, jnum(lg, "$.data[0].amount")) \
        .when(m == LOCK, jnum(lg, "$.data[0].locked_near_balance"))
    ev = _base(silver, cfg).where(m.isin(REG, DEP, LOCK)).select(
        "method_name", voter.alias("registered_voter_id"),
        F.struct("block_timestamp", "receipt_id", "receiver_id", "block_height", "block_hash",
                 amount.alias("amount"),
                 F.when(m == LOCK, jnum(lg, "$.data[0].timestamp")).alias("lock_ns")).alias("e"))
    e = F.col("e")
    return ev.groupBy("registered_voter_id").agg(
        F.min(F.when(m == REG, e)).alias("reg"),
        F.min(F.when((m == DEP) & e["amount"].isNotNull(), e)).alias("dep"),
        F.max(F.when(m == LOCK, e)).alias("lock"),
    )


def first_registration(silver: DataFrame, cfg: ContractConfig, events: DataFrame | None = None) -> DataFrame:
    g = (events if events is not None else voter_events(silver, cfg))
    f = F.col("reg")
    return g.where(f.isNotNull() & F.col("registered_voter_id").isNotNull()).select(
        f["receipt_id"].alias("receipt_id"), f["receiver_id"].alias("receiver_id"),
        f["block_timestamp"].alias("block_timestamp"), f["block_height"].alias("block_height"),
        f["block_hash"].alias("block_hash"), "registered_voter_id",
        epoch_ns(f["block_timestamp"]).alias("registered_at_ns"))


def first_deposit(silver: DataFrame, cfg: ContractConfig, events: DataFrame | None = None) -> DataFrame:
    g = (events if events is not None else voter_events(silver, cfg))
    return g.where(F.col("dep").isNotNull()).select(
        "registered_voter_id", F.col("dep.amount").alias("voting_power_from_vote_registration"))


def latest_lock(silver: DataFrame, cfg: ContractConfig, events: DataFrame | None = None) -> DataFrame:
    g = (events if events is not None else voter_events(silver, cfg))
    return g.where(F.col("lock").isNotNull()).select(
        F.col("registered_voter_id").alias("lk_voter"),
        F.col("lock.amount").alias("voting_power_from_locks_unlocks"),
        F.col("lock.lock_ns").alias("lockup_update_at_ns"))


def registered(silver: DataFrame, cfg: ContractConfig, events: DataFrame) -> DataFrame:
    """First registration that also has a deposit, with the voter's latest lock (one row per voter)."""
    f = F.col("reg")
    return events.where(f.isNotNull() & F.col("registered_voter_id").isNotNull() & F.col("dep").isNotNull()) \
        .select(f["receipt_id"].alias("receipt_id"), f["receiver_id"].alias("receiver_id"),
                f["block_timestamp"].alias("block_timestamp"), f["block_height"].alias("block_height"),
                f["block_hash"].alias("block_hash"), "registered_voter_id",
                epoch_ns(f["block_timestamp"]).alias("registered_at_ns"),
                F.col("dep.amount").alias("voting_power_from_vote_registration"),
                F.col("lock").isNotNull().alias("has_locked_unlocked_near"),
                F.col("lock.amount").alias("voting_power_from_locks_unlocks"),
                F.col("lock.lock_ns").alias("lockup_update_at_ns"))


def participation(pvh: DataFrame, recent: DataFrame) -> DataFrame:
    """Votes on the ten most recent approvals per voter, as a rate out of 10.

    Computed for every voter with a vote; the left join onto registered voters
    keeps exactly the registered ones (NULL rate when a voter never voted).
    ``recent`` has at most ten rows, so it is broadcast; duplicates in it
    (a proposal approved twice) count twice, as in the reference.
    """
    votes = pvh.select(F.col("voter_id").alias("registered_voter_id"), "proposal_id")
    tagged = votes.join(F.broadcast(recent.select(F.col("proposal_id").alias("t_pid"))),
                        F.col("proposal_id") == F.col("t_pid"), "left")
    s = F.sum(F.when(F.col("t_pid").isNull(), F.lit(0)).otherwise(F.lit(1)))
    return tagged.groupBy("registered_voter_id").agg(
        (s.cast("double") / F.lit(float(RECENT_APPROVALS))).alias("proposal_participation_rate"))


def unit_seconds(principal, now_ns, since_ns):
    """Whole units of the principal times whole seconds."""
    units = floor_div(principal, TEN_POW_21)
    secs = (floor_div(now_ns, TEN_POW_9) - floor_div(since_ns, TEN_POW_9)).cast("decimal(38,0)")
    return F.try_multiply(units, secs).cast("decimal(38,0)")


def reward(units, rate):
    """``units``: unit seconds; ``rate``: struct(q, scale) of the growth rate."""
    return scaled_product(units, rate["q"], F.lit(30) - rate["scale"])


def voter_stages(silver: DataFrame, cfg: ContractConfig, pvh: DataFrame, de: DataFrame,
                 approved: DataFrame, distinct_recent: bool = False) -> DataFrame:
    """Per-voter frame with principal and reward.

    ``distinct_recent=True`` counts a proposal approved twice once among the ten
    most recent approvals (the default keeps the reference's double count).
    """
    from govlake.plans.delegation_events import latest_delegation

    rv = registered(silver, cfg, voter_events(silver, cfg))
    recent = approved.orderBy(F.col("proposal_approved_at").desc(), F.col("receipt_id").desc()) \
        .limit(RECENT_APPROVALS).select("proposal_id")
    if distinct_recent:
        recent = recent.distinct()
    pp = participation(pvh, recent)
    ld = latest_delegation(de).withColumnRenamed("delegatee_id", "de_delegatee_id")
    now_ns = epoch_ns(cfg.as_of_column())
    tj = (rv.join(_growth_by_contract(silver, cfg), F.col("receiver_id") == F.col("gc_contract"), "left")
          .select("*", F.explode_outer("rates").alias("rate")).select("*", "rate.*").drop("rates", "rate")
          # a rate that was given several times repeats its voters, as in the reference
          .withColumn("times", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1))))).drop("times")
          .join(pp, "registered_voter_id", "left")
          .join(ld, F.col("registered_voter_id") == F.col("delegator_id"), "left"))
    zero = F.lit(0).cast("decimal(38,0)")
    locks = F.coalesce(F.col("voting_power_from_locks_unlocks"), zero)
    initial = F.coalesce(F.col("voting_power_from_vote_registration"), zero)
    tj = tj.select(
        "*",
        F.col("delegator_id").isNotNull().alias("is_actively_delegating"),
        F.col("de_delegatee_id").alias("delegatee_id"),
        locks.alias("vp_locks"), initial.alias("vp_initial"),
        (locks + initial).cast("decimal(38,0)").alias("principal_balance"),
    )
    since = F.when(F.col("has_locked_unlocked_near"), F.col("lockup_update_at_ns")) \
        .otherwise(F.col("registered_at_ns").cast("decimal(38,0)"))
    # a column of its own: now_ns may be a subquery, which the product's lambdas can't hold
    tj = tj.withColumn("unit_seconds", unit_seconds(F.col("principal_balance"), now_ns, since))
    tj = tj.withColumn("extra_venear_on_principal", reward(F.col("unit_seconds"), F.col("growth_quotient"))).drop("unit_seconds")
    return tj


def delegated_power(tj: DataFrame) -> DataFrame:
    """One hop, partial aggregation absorbs a delegatee with very many delegators."""
    return tj.where(F.col("delegatee_id").isNotNull()).groupBy("delegatee_id").agg(
        F.sum("principal_balance").cast("decimal(38,0)").alias("delegated_balance"),
        F.sum("extra_venear_on_principal").cast("decimal(38,0)").alias("delegated_extra_venear"),
    )


def _with_delegated(tj: DataFrame) -> DataFrame:
    """Each voter's rows with the sums of what others delegate to it, from one pass over ``tj``.

    Every row sends itself to its voter and its amounts to its delegatee; one partial
    aggregate per account then holds both, so the voter pipeline is planned once and nothing is joined.
    """
    own = F.struct(*[F.col(c) for c in tj.columns])
    amount = "decimal(38,0)"
    sent = F.array(
        F.struct(F.col("registered_voter_id").alias("account"), own.alias("own"), F.lit(None).cast(amount).alias("balance"),
                 F.lit(None).cast(amount).alias("extra")),
        F.struct(F.col("delegatee_id").alias("account"), F.lit(None).cast(tj.schema).alias("own"),
                 F.col("principal_balance").alias("balance"), F.col("extra_venear_on_principal").alias("extra")))
    rows = tj.select(F.explode(sent).alias("s")).select("s.*").where(F.col("account").isNotNull())
    g = rows.groupBy("account").agg(
        F.collect_list("own").alias("rows"), F.sum("balance").cast(amount).alias("delegated_balance"),
        F.sum("extra").cast(amount).alias("delegated_extra_venear"))
    return g.select(F.explode("rows").alias("own"), "delegated_balance", "delegated_extra_venear").select(
        "own.*", "delegated_balance", "delegated_extra_venear")


def registered_voters(silver: DataFrame, cfg: ContractConfig, pvh: DataFrame, de: DataFrame,
                      approved: DataFrame, distinct_recent: bool = False) -> DataFrame:
    out = _with_delegated(voter_stages(silver, cfg, pvh, de, approved, distinct_recent))
    zero = F.lit(0).cast("decimal(38,0)")
    total = (F.coalesce("principal_balance", zero) + F.coalesce("extra_venear_on_principal", zero)
             + F.coalesce("delegated_balance", zero) + F.coalesce("delegated_extra_venear", zero))
    return out.select(
        F.md5("receipt_id").alias("id"), "receipt_id",
        F.to_date("block_timestamp").alias("registered_date"), F.col("block_timestamp").alias("registered_at"),
        "registered_voter_id", F.col("receiver_id").alias("hos_contract_address"),
        "has_locked_unlocked_near", "is_actively_delegating", "delegatee_id", "proposal_participation_rate",
        F.col("vp_locks").alias("voting_power_from_locks_unlocks"),
        F.col("vp_initial").alias("initial_voting_power"),
        "principal_balance", "extra_venear_on_principal",
        F.coalesce("delegated_balance", zero).alias("voting_power_from_delegations"),
        F.coalesce("delegated_extra_venear", zero).alias("delegated_extra_venear"),
        F.when(F.col("is_actively_delegating"), zero).otherwise(total.cast("decimal(38,0)"))
        .alias("current_voting_power"),
        "block_height", "block_hash",
    )
