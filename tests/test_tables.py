"""Sources, sinks, skewed customers, streaming and the whole run."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from driftwise.operators.fusion import with_fusion
from driftwise.operators.ranges import with_ordered_range
from driftwise.plans import bindings
from driftwise.plans.book import COMMISSION_SCHEMA, main
from driftwise.session import new_table_path, shared_dir, stage
from driftwise.sources.tables import kind_type, read_delimited, read_table, without_identifiers, write_delimited, write_table
from driftwise.streaming.scoring import score_stream


def test_delimited_with_mark_accents_gaps_and_big_ids(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id;faixa;valor;n\n1.14E+12;até 0.99;;3\n1.5E+3;ção;2.5;\n", encoding="utf-8-sig")
    rows = read_delimited(spark, str(path), "id double, faixa string, valor double, n bigint").collect()
    assert [tuple(r) for r in rows] == [(1.14e12, "até 0.99", None, 3), (1500.0, "ção", 2.5, None)]


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;b", 0.1), (2, None, None)], "k bigint, s string, x double")
    write_delimited(df, str(tmp_path / "out"))
    back = read_delimited(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a;b", 0.1), (2, None, None)]


def test_parquet_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(3), path)
    assert read_table(spark, path).count() == 3


def test_identifiers_are_dropped_or_hashed(spark):
    df = spark.createDataFrame([(1, 11, 5.0)], "id bigint, person bigint, x double")
    out = without_identifiers(df, drop=["id", "absent"], hashed=["person"], salt="s")
    assert out.columns == ["person", "x"] and len(out.first().person) == 64


def test_staged_tables_live_in_the_shared_folder(spark):
    df = stage(spark.range(10), "t")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert df.count() == 10 and shared_dir(spark) in df.inputFiles()[0]
    dealt = stage(spark.range(10).coalesce(1), "t", spread=True)
    assert dealt.count() == 10 and dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert new_table_path(spark, "t") != new_table_path(spark, "t")


@pytest.mark.parametrize("hot", [1, 3, 8])
def test_hot_customers_get_the_same_previous_policy(spark, sf_dir, hot):
    plain = bindings.renewals(spark, sf_dir)
    split = bindings.renewals(spark, sf_dir, hot_orders=hot)
    assert len(bindings.hot_customers(bindings.table(spark, sf_dir, "orders"), hot)) > 0
    assert plain.count() == split.count()
    assert plain.exceptAll(split.select(*plain.columns)).count() == 0


@pytest.mark.parametrize("ranges", [1, 2, 9, 500])
def test_skewed_customer_by_range(spark, ranges):
    """Two customers, one with most of the rows, and several orders on one day."""
    rows = [(i, 7 if i % 4 else 8, f"20{10 + i % 9}-{1 + i % 5:02d}-{1 + i % 27:02d}", float(i), float(i)) for i in range(200)]
    policies = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, d string, pct double, insured double").select(
        "o_orderkey", "o_custkey", F.col("d").cast("timestamp_ntz").alias("o_orderdate"), F.lit("p").alias("o_orderpriority"),
        F.lit("s").alias("o_orderstatus"), F.col("pct").alias("o_totalprice"), F.when(F.col("o_orderkey") % 3 > 0, F.col("pct")).alias("pct"), "insured",
    )
    plain, by_range = bindings._with_previous(policies), bindings._with_previous_by_range(policies, ranges)
    assert sorted(map(str, plain.collect())) == sorted(map(str, by_range.select(*plain.columns).collect()))


@pytest.mark.parametrize("ranges", [2, 40, 300])
def test_one_instant_and_missing_times_are_cut_too(spark, ranges):
    """One customer with most of its orders at one instant and many without a time."""
    rows = [(i * 7919 % 3001, 7, None if i % 3 == 0 else "2020-01-01 10:00:00.000001" if i % 3 == 1 else f"2020-01-01 10:00:00.{i:06d}") for i in range(900)]
    policies = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, d string").select(
        "o_orderkey", "o_custkey", F.col("d").cast("timestamp_ntz").alias("o_orderdate"),
        *[F.col("o_orderkey").cast("double").alias(c) for c in ("o_totalprice", "pct", "insured")],
    )
    plain, by_range = bindings._with_previous(policies), bindings._with_previous_by_range(policies, ranges)
    assert sorted(map(str, plain.collect())) == sorted(map(str, by_range.select(*plain.columns).collect()))
    timed = policies.withColumn("t", F.when(F.col("o_orderdate").isNotNull(), F.lit(1.0)))
    sizes = [r["count"] for r in with_ordered_range(timed, "t", "o_orderkey", "r", ranges).groupBy("r").count().collect()]
    assert max(sizes) <= 4 * 900 / ranges + 4


def test_hot_path_keeps_orders_without_a_date(spark, sf_dir, tmp_path):
    for name in ("orders", "customer", "lineitem", "nation", "region"):
        df = bindings.table(spark, sf_dir, name)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 97 > 0, F.col("o_orderdate")))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    plain, split = (bindings.renewals(spark, str(tmp_path), hot_orders=n) for n in (10**9, 10))
    assert plain.count() == split.count() and plain.exceptAll(split.select(*plain.columns)).count() == 0


def test_nan_on_parquet_is_missing(spark, tmp_path):
    spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "`a.b` double, n int").write.parquet(str(tmp_path / "t"))
    assert {r["a.b"] for r in read_table(spark, str(tmp_path / "t")).collect()} == {None, 2.0}


def test_fusion_on_a_stream_equals_the_batch(spark, renewal_rows, tmp_path):
    columns = ["policy_id", "pct_before", "pct_after", "reg_pred", "class_pred"]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    renewal_rows.select(*columns).repartition(3).write.parquet(source)

    def score(df):
        return with_fusion(df, "pct_before", "pct_after", "reg_pred", "class_pred")

    stream = spark.readStream.schema(renewal_rows.select(*columns).schema).parquet(source)
    score_stream(stream, score, out, str(tmp_path / "checkpoint")).awaitTermination(120)
    batch, streamed = score(renewal_rows.select(*columns)), spark.read.parquet(out)
    assert streamed.count() == batch.count()
    assert batch.exceptAll(streamed.select(*batch.columns)).count() == 0


def book_file(folder, n):
    """Invented rows in the shape of the commission book, whose change follows a score; no value
    is taken from anywhere."""
    rng = random.Random(8)
    names = [c.split() for c in COMMISSION_SCHEMA.replace("\n", " ").split(",")]
    texts = {"fabricante": ["F1", "F2", "F3"], "faixa_ajuste_medio": ["4. De 0.95 até 0.99", "5. De 1.0 até 1.1"], "Origem": ["A", "B"], "filial_antes": ["X", "Y", "Z"]}
    lines = [";".join(n for n, _ in names)]
    for i in range(n):
        row = {}
        for name, kind in names:
            if kind == "string":
                row[name] = rng.choice(texts.get(name, ["K"]))
            elif name in ("Score_Serasa_depois", "Score_RF_depois", "Score_Sinistro_depois") and i % 3:
                row[name] = ""
            elif name.startswith("Score"):
                row[name] = str(rng.randint(400, 900))
            elif name.startswith("Premio"):
                row[name] = f"{rng.uniform(1000, 3800):.2f}"
            elif name.startswith("pct"):
                row[name] = str(rng.choice([10, 12.5, 15, 20, 25]))
            elif kind == "bigint":
                row[name] = str(rng.randint(1, 30))
            else:
                row[name] = f"{rng.uniform(-500, 800):.2f}"
        score = int(row["Score_Serasa_antes"])
        change = 2 if score > 720 else -2 if score < 560 else 0
        row["pct_comiss_depois"] = str(float(row["pct_comiss_antes"]) + change)
        lines.append(";".join(row[n] for n, _ in names))
    path = folder / "book.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8-sig")
    return str(path)


def test_whole_run(spark, tmp_path):
    out = str(tmp_path / "out")
    main(["--csv", book_file(tmp_path, 2500), "--out", out, "--select", "3"])
    output = spark.read.parquet(f"{out}/output")
    assert output.count() == 2500 and "cpf_cnpj" not in output.columns
    assert {"class_pred", "reg_pred", "fused_pred", "reg_direction", "real_direction", "fused_direction"} <= set(output.columns)
    assert output.filter("reg_pred < 0 OR fused_pred < 0").count() == 0
    kpis = {(r.metric, r.split): r.value for r in spark.read.parquet(f"{out}/reports/kpis").collect()}
    assert kpis["n_rows", "all"] == 2500 == kpis["n_rows", "train"] + kpis["n_rows", "test"]
    assert kpis["accuracy", "test"] > 0.6 and kpis["r2", "test"] > 0.9
    assert spark.read.parquet(f"{out}/reports/selected_features").count() == 3
    assert spark.read.parquet(f"{out}/reports/qq").count() == kpis["n_rows", "test"]
    assert spark.read.parquet(f"{out}/fit/numbers").filter("step = 'weight'").count() > 0
    areas = spark.read.parquet(f"{out}/reports/areas").collect()
    assert len(areas) == 3 and all(0.5 < r.auc <= 1 for r in areas)


def test_types_are_inferred_from_all_rows_of_all_files(spark, tmp_path):
    head = "id;long;huge;zeros;mixed;share;none;name;drift;exp;nan\n"
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("﻿" + head + "1;123456789012345678;12345678901234567890;007;123456789012345678;0.5;;x;1;1e-3;NaN\n", "utf-8")
    (tmp_path / "a" / "2.csv").write_text(head + "-2;;1;12;1.5;3;;12;2.5;-.5;4\n" + "0;1;2;;;;;;;;\n", "utf-8")
    df = read_delimited(spark, str(tmp_path / "a"))
    types = dict(df.dtypes)
    assert types == {
        "id": "bigint", "long": "bigint", "huge": "string", "zeros": "string", "mixed": "string", "share": "double",
        "none": "double", "name": "string", "drift": "double", "exp": "double", "nan": "bigint",
    }
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["long"] == 123456789012345678 and rows[1]["huge"] == "12345678901234567890" and rows[1]["zeros"] == "007"
    assert rows[1]["nan"] is None and rows[-2]["nan"] == 4 and rows[-2]["share"] == 3.0 and rows[0]["name"] is None
    (tmp_path / "empty.csv").write_text("a;b.c\n")
    empty = read_delimited(spark, str(tmp_path / "empty.csv"))
    assert empty.dtypes == [("a", "double"), ("b.c", "double")] and empty.count() == 0


def test_kinds_merge_over_files():
    assert [kind_type(k) for k in ({"whole"}, {"whole", "long"}, {"whole", "real"}, {"long", "real"}, {"text", "whole"}, set())] == [
        LongType(), LongType(), DoubleType(), StringType(), StringType(), DoubleType(),
    ]


def test_seed_layout_gets_its_declared_types(spark, tmp_path):
    """A row of the declared columns written out and read without the schema."""
    declared = spark.createDataFrame([], COMMISSION_SCHEMA).schema
    value = {"string": "text", "double": 1.5, "bigint": 7, "int": 7}
    df = spark.createDataFrame([tuple(value.get(f.dataType.simpleString()) for f in declared.fields)], declared)
    write_delimited(df, str(tmp_path / "seed"))
    inferred = read_delimited(spark, str(tmp_path / "seed")).schema
    wide = {"int": "bigint"}
    for a, b in zip(declared.fields, inferred.fields):
        kind = a.dataType.simpleString()
        if kind in value:
            assert (a.name, wide.get(kind, kind)) == (b.name, b.dataType.simpleString())
