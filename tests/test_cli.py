"""The command line: generate landed files, then run the job on them."""

import tempfile

from salesmart.cli import main
from tests.seed import dimensions


def test_generate_then_run(spark):
    work = tempfile.mkdtemp(prefix="salesmart-cli-")
    main(["generate-sales", "--out", f"{work}/land/base", "--rows", "500"], spark=spark)
    main(["generate-sales", "--out", f"{work}/land/extra", "--rows", "100", "--layout", "extra", "--seed", "1"],
         spark=spark)
    main(["generate-sales", "--out", f"{work}/land/missing", "--rows", "50", "--layout", "missing"], spark=spark)
    main(["generate-sales", "--out", f"{work}/land/day", "--rows", "200", "--day", "2023-08-20"], spark=spark)
    main(["generate-customers", "--out", f"{work}/gen_customers", "--rows", "25"], spark=spark)
    customer, store, product, team = dimensions(spark)
    for name, df in [("customer", customer), ("store", store), ("product", product), ("team", team)]:
        df.write.parquet(f"{work}/dims/{name}")
    rep = main(
        ["run", "--landing", f"{work}/land", "--out", f"{work}/out", "--customer", f"{work}/dims/customer",
         "--store", f"{work}/dims/store", "--sales-team", f"{work}/dims/team", "--product", f"{work}/dims/product"],
        spark=spark,
    )
    n_files = sum(1 for _ in spark.read.text(f"{work}/land/missing").inputFiles())
    assert rep["rejected_files"] == n_files
    mart = spark.read.parquet(rep["paths"]["sales_team_month_mart"])
    # 500 + 100 + 200 generated rows, all with known customers / stores / sellers
    assert spark.read.parquet(rep["paths"]["enriched"]).count() == 800
    assert mart.where("incentive > 0").count() >= 1
    assert spark.read.option("header", True).csv(f"{work}/gen_customers").count() == 25


def test_options_reach_the_job(spark, monkeypatch):
    """Tables, takeover and splitting are handed on; a stream has no product to ignore."""
    import pytest

    from salesmart import cli
    from salesmart.plans import pipeline as PL

    given = {}

    def run(spark, landing, out, customer, store, team, **options):
        given.update(options)
        return PL.PipelineResult(out, "l", 0, 1, 0, 0)

    monkeypatch.setattr(PL, "run_pipeline", run)
    monkeypatch.setattr(cli, "load_dimension", lambda spark, spec, args: spec)
    dims = ["--landing", "L", "--out", "O", "--customer", "C", "--store", "S", "--sales-team", "T"]
    main(["run", *dims, "--product", "P", "--takeover", "--split-files", "--mart-tables"], spark=spark)
    assert given["product"] == "P" and given["takeover"] and not given["multi_line"] and given["table_options"] == {}
    main(["run", *dims, "--mart-jdbc-url", "jdbc:x", "--jdbc-user", "u"], spark=spark)
    assert given["table_options"] == {"url": "jdbc:x", "properties": {"user": "u"}} and given["multi_line"]
    main(["run", *dims], spark=spark)
    assert given["table_options"] is None and given["product"] is None
    with pytest.raises(SystemExit):
        main(["stream", *dims, "--checkpoint", "K", "--product", "P"], spark=spark)


def test_jdbc_dimensions_name_their_partition_column(spark, monkeypatch):
    from types import SimpleNamespace

    from salesmart import cli
    from salesmart.sources import tables as ST

    asked = []
    monkeypatch.setattr(ST, "read_table", lambda spark, table, **options: asked.append((table, options)))
    args = SimpleNamespace(jdbc_url="jdbc:x", jdbc_user="u", jdbc_password=None, jdbc_driver=None, jdbc_partitions=4)
    cli.load_dimension(spark, "customer@customer_id", args)
    cli.load_dimension(spark, "store", args)
    same = {"url": "jdbc:x", "properties": {"user": "u"}}
    assert asked == [("customer", {**same, "partition_column": "customer_id", "num_partitions": 4}), ("store", same)]
