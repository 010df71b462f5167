"""Pure Column expressions that derive the report dimensions from raw job rows.

All are built-in Spark SQL functions, so they stay inside whole-stage codegen.
Null handling follows the rule set: every classification ends in an
``otherwise`` branch, so a null input lands in the default class.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sacctlens import schema as S


def _c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def outcome(state="State") -> Column:
    """COMPLETED only for the exact state COMPLETED; anything else (null included) is FAILED."""
    return F.when(_c(state) == S.COMPLETED_STATE, F.lit("COMPLETED")).otherwise(F.lit("FAILED"))


def normalised_state(state="State") -> Column:
    """Collapse ``CANCELLED by <uid>`` variants to ``CANCELLED``; other states unchanged.

    The regex only runs on states containing ``CANCELLED`` (it cannot match others).
    """
    st = _c(state)
    return F.when(st.contains("CANCELLED"), F.regexp_replace(st, S.CANCELLED_PATTERN, "CANCELLED")) \
            .otherwise(st)


def cluster(partition="Partition") -> Column:
    """ARM when the partition name contains ``arm``, else GPU on ``a100``, else AMD."""
    p = _c(partition)
    return (F.when(p.contains(S.ARM_MARK), F.lit("ARM"))
            .when(p.contains(S.GPU_MARK), F.lit("GPU"))
            .otherwise(F.lit("AMD")))


def agency(account="Account") -> Column:
    """FCT for accounts starting with ``f``, EHPC for ``ee``, LOCAL otherwise."""
    a = _c(account)
    return (F.when(a.startswith(S.FCT_PREFIX), F.lit("FCT"))
            .when(a.startswith(S.EHPC_PREFIX), F.lit("EHPC"))
            .otherwise(F.lit("LOCAL")))


def is_gpu_partition(partition="Partition") -> Column:
    return _c(partition).contains(S.GPU_MARK)


def old_vnodes(partition="Partition", alloc_cpus="AllocCPUS", nnodes="NNodes") -> Column:
    """Former GPU slot rule: one slot per started block of 32 CPUs on a100 partitions."""
    slots = F.ceil(_c(alloc_cpus) / F.lit(S.CPUS_PER_GPU_SLOT)).cast("bigint")
    return F.when(is_gpu_partition(partition), slots).otherwise(_c(nnodes).cast("bigint"))


def vnodes(partition="Partition", alloc_tres="AllocTRES", nnodes="NNodes") -> Column:
    """Billing units of a job: GPUs on a100 partitions, nodes elsewhere.

    On a100: no TRES string -> NNodes; ``gres/gpu=N`` present -> N (first match);
    any other TRES string (e.g. a typed ``gres/gpu:a100=4``) -> NNodes x 4.
    """
    tres = _c(alloc_tres)
    n = _c(nnodes).cast("bigint")
    # One regex evaluation: the captured digits are non-empty exactly when it matches.
    digits = F.regexp_extract(tres, S.GPU_TRES_PATTERN, 1)
    gpu_units = (F.when(tres.isNull(), n)
                 .when(digits != "", digits.try_cast("bigint"))
                 .otherwise(F.try_multiply(n, F.lit(S.GPUS_PER_NODE).cast("bigint"))))
    return F.when(is_gpu_partition(partition), gpu_units).otherwise(n)


def job_seconds(elapsed="ElapsedRaw", units: Column | None = None) -> Column:
    """Allocated unit-seconds: elapsed seconds x billing units (bigint).

    A product beyond bigint is null, as numbers that do not parse are.
    """
    u = vnodes() if units is None else units
    return F.try_multiply(_c(elapsed).cast("bigint"), u)


def enrich(raw) -> "DataFrame":  # noqa: F821
    """Add the derived columns to a frame holding the seven raw job columns."""
    units = vnodes()
    return raw.select(
        "*",
        normalised_state().alias("estate"),
        outcome().alias("outcome"),
        cluster().alias("cluster"),
        agency().alias("agency"),
        old_vnodes().alias("old_vnodes"),
        units.alias("vnodes"),
        job_seconds(units=units).alias("job_seconds"),
    )
