"""Expression tests on hand-made accounting rows with expected derived values."""

from sacctlens.functions import enrich as E
from sacctlens.plans.explain import plan_text
from sacctlens.schema import JOB_SCHEMA
from sacctlens.sources.local import local_rows

RAW_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in JOB_SCHEMA.fields)

# (Partition, Account, State, AllocCPUS, AllocTRES, ElapsedRaw, NNodes)
#   -> cluster, agency, outcome, estate, old_vnodes, vnodes, job_seconds
CASES = [
    (("normal-arm", "f001", "COMPLETED", 48, "cpu=48", 3600, 2),
     ("ARM", "FCT", "COMPLETED", "COMPLETED", 2, 2, 7200)),
    (("dev-a100-40", "ee01", "CANCELLED by 77", 33, "cpu=33,gres/gpu=3", 7200, 1),
     ("GPU", "EHPC", "FAILED", "CANCELLED", 2, 3, 21600)),
    (("dev-a100-80", "x", "FAILED", 16, None, 100, 1),
     ("GPU", "LOCAL", "FAILED", "FAILED", 1, 1, 100)),
    (("dev-a100-80", "f", "TIMEOUT", 32, "cpu=32", 100, 2),
     ("GPU", "FCT", "FAILED", "TIMEOUT", 1, 8, 800)),
    (("normal-x86", None, None, 8, "cpu=8", 10, 1),
     ("AMD", "LOCAL", "FAILED", None, 1, 1, 10)),
    ((None, "ee", "COMPLETED", 8, "cpu=8", 10, 1),
     ("AMD", "EHPC", "COMPLETED", "COMPLETED", 1, 1, 10)),
    (("normal-a100", "ee", "COMPLETED", 8, "gres/gpu:a100=4", 10, 1),
     ("GPU", "EHPC", "COMPLETED", "COMPLETED", 1, 4, 40)),
    # both marks: the cluster is ARM, but the a100 allocation rules still apply
    (("arm-a100", "f", "COMPLETED", 64, "gres/gpu=2", 10, 3),
     ("ARM", "FCT", "COMPLETED", "COMPLETED", 2, 2, 20)),
    # two gres entries: the first one counts
    (("a100", "ee9", "RUNNING", 4, "cpu=4,gres/gpu=12,gres/gpu=3", 1, 1),
     ("GPU", "EHPC", "FAILED", "RUNNING", 1, 12, 12)),
    # case sensitive: ARM / EE do not match
    (("ARM", "EE1", "completed", 0, None, 5, 1),
     ("AMD", "LOCAL", "FAILED", "completed", 1, 1, 5)),
    # null elapsed -> null seconds
    (("normal-arm", "f", "COMPLETED", 1, None, None, 4),
     ("ARM", "FCT", "COMPLETED", "COMPLETED", 4, 4, None)),
]


def test_enrich_rules(spark):
    raw = local_rows(spark, [c[0] for c in CASES], RAW_DDL)
    got = E.enrich(raw).select("cluster", "agency", "outcome", "estate", "old_vnodes", "vnodes",
                               "job_seconds").collect()
    assert [tuple(r) for r in got] == [c[1] for c in CASES]


def test_enrich_types(spark):
    raw = local_rows(spark, [CASES[0][0]], RAW_DDL)
    types = dict(E.enrich(raw).dtypes)
    assert types["vnodes"] == "bigint"
    assert types["old_vnodes"] == "bigint"
    assert types["job_seconds"] == "bigint"


def test_enrich_is_codegen_friendly(spark):
    """No Python UDF in the derivation: the plan only holds built-in expressions."""
    raw = local_rows(spark, [c[0] for c in CASES], RAW_DDL)
    plan = plan_text(E.enrich(raw))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
