import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.fixed_values import LOOKUP_FEATURES, REGION_CODES
from riskloom.operators import encode
from riskloom.sources import delimited, schemas, tables
from riskloom.sources.synthetic import (
    CORE_DRAWS,
    application_table,
    bureau_draws,
    generate_subjects,
    subject_table,
)

APPLICATIONS = '''application_id,subject_id,app_date,region_code,product_code,lender_code,channel,requested_amount,tenor_months,decision
APP00000001,SUBJ000000001,2025-01-31,DKI,KTA,BNK001,"Mobile, App",15000000,12,APPROVE
APP00000002,SUBJ000000002,2025-02-01,"",NULL,null,"say ""hi""",,24,REVIEW
'''


def test_csv_quotes_and_null_tokens(spark, tmp_path):
    path = tmp_path / "applications.csv"
    path.write_text(APPLICATIONS)
    first, second = delimited.read_delimited(spark, str(path), schemas.LOAN_APPLICATIONS).orderBy(
        "application_id"
    ).collect()
    assert first.app_date == dt.date(2025, 1, 31) and first.channel == "Mobile, App"
    assert int(first.requested_amount) == 15000000
    assert (second.region_code, second.product_code, second.lender_code) == (None, None, None)
    assert second.requested_amount is None and second.channel == 'say "hi"'


def test_a_value_that_does_not_fit_raises(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(APPLICATIONS.replace("2025-01-31", "yesterday"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        delimited.read_delimited(spark, str(path), schemas.LOAN_APPLICATIONS).collect()


def test_compressed_file_and_repeated_append(spark, tmp_path):
    import gzip

    path = tmp_path / "dim_region.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("region_code,region_name,island_group\nDKI,DKI Jakarta,Jawa\n")
    table = str(tmp_path / "region")
    for loads in (1, 2):
        delimited.append_delimited(spark, str(path), schemas.DIM_REGION, table)
        assert tables.scan(spark, table).count() == loads
    empty = spark.createDataFrame([], schemas.DIM_REGION)
    assert tables.replace_table(empty, table).count() == 0


def test_replace_in_another_format_and_by_partition(spark, tmp_path):
    df = generate_subjects(spark, 50).select("subject_id", "education", "age")
    orc = tables.replace_table(df, str(tmp_path / "orc"), file_format="orc")
    split = tables.replace_table(df, str(tmp_path / "split"), ["education"])
    assert orc.exceptAll(df).count() == 0 and split.select(df.columns).exceptAll(df).count() == 0


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    with pytest.raises(Exception):
        tables.replace_table(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert tables.scan(spark, path).count() == 5
    tables.append_table(spark.range(2), path)
    assert tables.scan(spark, path).count() == 7
    tables.replace_table(spark.range(1), path)
    assert tables.scan(spark, path).count() == 1


def test_key_violations(rows):
    df = rows("id int", (1,), (2,), (2,), (None,))
    assert {r.id: r.occurrences for r in tables.key_violations(df, "id").collect()} == {2: 2, None: 1}


def test_exclude_refuses_unknown_columns(rows):
    df = rows("a int, b int", (1, 2))
    assert tables.exclude(df, "b").columns == ["a"]
    with pytest.raises(ValueError):
        tables.exclude(df, "c")


def test_clustered_table_prunes_a_key_lookup(spark, tmp_path):
    df = subject_table(spark.range(2000), "id").select("subject_id", "age")
    stored = tables.write_clustered(df, str(tmp_path / "lookup"), "subject_id", 4)
    files = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min("subject_id").alias("lo"), F.max("subject_id").alias("hi")
    ).orderBy("lo").collect()
    assert len(files) > 1 and all(a.hi < b.lo for a, b in zip(files, files[1:]))
    plan = stored.where("subject_id = 'SUBJ000000042'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(subject_id), EqualTo(subject_id,SUBJ000000042)]" in plan


def test_subject_table_shape(spark):
    df = generate_subjects(spark, 500)
    assert len(bureau_draws()) == 170 and len(CORE_DRAWS) == 24 and len(df.columns) == 198
    assert set(LOOKUP_FEATURES) <= set(df.columns)
    assert tables.key_violations(df, "subject_id").count() == 0


def test_subjects_do_not_depend_on_partitioning(spark):
    one = subject_table(spark.range(0, 300, 1, 1), "id")
    many = subject_table(spark.range(0, 300, 1, 7), "id")
    assert one.exceptAll(many).count() == 0


def test_default_rate_and_correlations(spark):
    df = generate_subjects(spark, 200_000).select(
        "default_flag", "pd_true", "age", "monthly_income", "gender", "region_code", "max_dpd_12m"
    )
    r = df.agg(
        F.avg("default_flag").alias("rate"), F.avg("pd_true").alias("pd"),
        F.corr("age", "monthly_income").alias("rho"), F.avg((F.col("gender") == "M").cast("int")).alias("m"),
        F.count_distinct("region_code").alias("regions"),
    ).first()
    assert abs(r.rate - 0.0819) < 0.002 and abs(r.rate - r.pd) < 0.002
    assert abs(r.rho) < 0.01 and abs(r.m - 0.55) < 0.01 and r.regions == len(REGION_CODES)


def test_application_log(spark):
    df = application_table(spark.range(20_000), "id", 1000)
    r = df.agg(
        F.min("app_date"), F.max("app_date"), F.avg((F.col("channel") == "Mobile App").cast("int")),
        F.avg((F.col("decision") == "APPROVE").cast("int")), F.min("requested_amount"),
    ).first()
    assert r[0] == dt.date(2025, 1, 1) and r[1] == dt.date(2026, 6, 30)
    assert abs(r[2] - 0.4) < 0.02 and 0.5 < r[3] < 0.7 and r[4] >= 1_200_000
    assert [f.dataType for f in df.schema.fields if f.name == "requested_amount"] == [T.DecimalType(18, 0)]


def test_scoring_view_has_sixty_inputs_in_order(spark):
    view = encode.scoring_view(generate_subjects(spark, 200))
    assert len(view.columns) == 61
    assert view.columns[1:4] == ["gender_f", "gender_m", "employment_type_freelance"]
    assert view.columns[30] == "region_code_yogya" and view.columns[31] == "age"
    assert view.columns[-1] == "dti_ratio"
    row = view.first().asDict()
    for field, width in [("gender", 2), ("employment_type", 5), ("education", 5), ("region_code", 18)]:
        flags = [v for k, v in row.items() if k.startswith(field + "_")]
        assert len(flags) == width and sum(flags) == 1.0


def test_learned_dummies_match_the_fixed_ones(spark):
    df = generate_subjects(spark, 2000).select("subject_id", "gender", "education", "age")
    categorical, numeric = encode.split_by_type(df, "subject_id")
    assert (categorical, numeric) == (["gender", "education"], ["age"])
    learned = encode.learn_categories(df, categorical)
    assert learned == {"gender": ["F", "M"], "education": ["D3", "S1", "S2", "SD", "SMA"]}
    assert encode.onehot(df, learned).columns == [
        "subject_id", "age", "gender_f", "gender_m", "education_d3", "education_s1", "education_s2",
        "education_sd", "education_sma",
    ]
    with pytest.raises(ValueError):
        encode.learn_categories(df, ["subject_id"], max_values=100)


def test_scaling_uses_the_training_parameters(rows):
    train = rows("a double, b double", (1.0, 5.0), (3.0, 5.0))
    scaled = encode.standard_scale(rows("a double, b double", (5.0, 5.0)), encode.scale_parameters(train, ["a", "b"]))
    assert tuple(scaled.first()) == (3.0, 0.0)


def test_a_warehouse_of_one_machine_is_refused_on_a_cluster():
    from riskloom.session import check_shared

    for folder, master in [("/tmp/w", "local[8]"), ("file:/tmp/w", "local"), ("hdfs://n/w", "yarn"), ("s3a://b/w", "spark://m:7077")]:
        check_shared(folder, master)
    for folder in ("file:/tmp/w", "/tmp/w", "file:///tmp/w"):
        with pytest.raises(ValueError, match="checkpoint"):
            check_shared(folder, "yarn")
