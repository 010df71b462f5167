import pytest

#: The operators run many small jobs here: few partitions, one job a query and no
#: code generation keep them short.  Taken back after each module: a package scope without
#: an __init__.py lasts as long as the session, and the tests elsewhere need the defaults.
SETTINGS = {"spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.enabled": "false", "spark.sql.codegen.wholeStage": "false"}


@pytest.fixture(scope="module", autouse=True)
def small_jobs(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
