"""Labels, choice lists, decoding and form split."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake.functions.choices import choices_map, parse_choices
from formlake.functions.text import elapsed_string, elapsed_text, title_case
from formlake.operators import labels as L
from formlake.operators.columns import blank_gray_status, project_families, project_fields
from formlake.operators.dictionary import record_id_name, with_config_row
from formlake.operators.forms import single_form, split_forms, split_forms_labeled
from formlake.operators.verbs import arrange, below_group_mean, select_fields

FIELDS = (
    "field_name string, form_name string, field_type string, field_label string, "
    "select_choices_or_calculations string"
)


def dictionary(spark, rows, record_id="record_id"):
    numbered = [(i, *r) for i, r in enumerate(rows)]
    return with_config_row(
        spark.createDataFrame(numbered, "position int, " + FIELDS), record_id
    )


@pytest.fixture(scope="module")
def study(spark):
    return dictionary(
        spark,
        [
            ("record_id", "planting", "text", "Tree number", None),
            ("grower", "planting", "text", "Grower", None),
            ("plot", "planting", "text", "Plot", None),
            ("stock", "planting", "radio", "Root stock", "0, Own root | 1, Grafted"),
            ("girth", "growth", "calc", "Girth", "round([w]/[h],1)"),
            ("soil", "soil", "checkbox", "Soil", "1, Alpha | 2, Beta, both"),
            ("notes", "soil", "notes", "", None),
            ("stock", "soil", "radio", "Second entry", "0, X | 1, Y"),
        ],
    )


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (1, "Abara", "a@x", 0, 22.25, 1, 0, None, 2),
        (2, "Abara", "b@x", 1, 30.5, 0, 1, "n", 0),
        (3, "Quill", None, 1, 18.75, 0, 0, None, 1),
        (4, "Osei", "d@x", 0, 41.0, 1, 1, None, 2),
        (5, "Varga", "e@x", 1, 36.5, None, 0, None, None),
    ]
    schema = (
        "record_id int, grower string, plot string, stock int, girth double, soil___1 int, "
        "soil___2 int, notes string, growth_complete int"
    )
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_choice_lists(spark):
    texts = {
        "1, Ripe | 0, Green | 99, Unseen": [("1", "Ripe"), ("0", "Green"), ("99", "Unseen")],
        "1, Yes, maybe | 2": [("1", "Yes, maybe")],
        "1,A|2,B": [("1", "A"), ("2", "B")],
        "": None,
        "no commas": None,
        "round([a]/[b],1)": [("round([a]/[b]", "1)")],
        "a, | , b": [("a", ""), ("", "b")],
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", parse_choices(F.col("t")).alias("c")).collect():
        want = texts[row["t"]]
        assert (None if row["c"] is None else [tuple(p) for p in row["c"]]) == want
    repeated = spark.createDataFrame([("1, A | 1, B | 2, C",)], "t string")
    assert repeated.select(choices_map(parse_choices(F.col("t")))).first()[0] == {"1": "A", "2": "C"}


def test_title_case(spark):
    names = {
        "finance_and_risk": "Finance and Risk",
        "the_end_of_day": "The End of Day",
        "phq_9": "Phq 9",
        "visit_b": "Visit b",
        "myForm_the": "myForm the",
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["t"] for r in df.select("n", title_case(F.col("n")).alias("t")).collect()}
    assert got == names


def test_elapsed(spark):
    seconds = [0.0, 0.5, 1.5, 59.4, 60.0, 61.6, 3725.0]
    df = spark.createDataFrame([(s,) for s in seconds], "s double").coalesce(1)
    got = [r[0] for r in df.select(elapsed_text(F.col("s"))).collect()]
    assert got == [elapsed_string(s) for s in seconds]
    assert got == ["0s", "0s", "2s", "59s", "1m 0s", "1m 2s", "62m 5s"]


def test_full_labelling(people, study):
    out = L.label(people, study)
    assert [r["stock"] for r in out.collect()] == ["Own root", "Grafted", "Grafted", "Own root", "Grafted"]
    assert [r["soil___1"] for r in out.collect()] == ["Alpha", None, None, "Alpha", None]
    assert [r["soil___2"] for r in out.collect()] == [None, "Beta, both", None, "Beta, both", None]
    assert [r["growth_complete"] for r in out.collect()] == [
        "Complete", "Incomplete", "Unverified", "Complete", None,
    ]
    labels = {f.name: f.metadata.get("label") for f in out.schema.fields}
    assert labels["stock"] == "Root stock"
    assert labels["soil___2"] == "Soil (Beta, both)"
    assert labels["growth_complete"] == "Complete? Growth"
    assert labels["notes"] is None
    assert out.schema["girth"].dataType == T.DoubleType()


def test_flag_combinations(people, study):
    raw = L.label(people, study, convert=False)
    assert raw.schema["stock"].dataType == T.IntegerType()
    assert raw.schema["stock"].metadata["value_labels"] == [
        {"code": "0", "label": "Own root"}, {"code": "1", "label": "Grafted"},
    ]
    assert "value_labels" not in raw.schema["girth"].metadata
    vals = L.label(people, study, cols=False, convert=False)
    assert "label" not in vals.schema["stock"].metadata
    cols = L.label(people, study, vals=False)
    assert [r["stock"] for r in cols.collect()] == [0, 1, 1, 0, 1]
    with pytest.raises(ValueError):
        L.label(people, study, cols=False, vals=False)


def test_no_dictionary_returns_data_unchanged(spark, people, study):
    with pytest.warns(UserWarning):
        assert L.label(people, None) is people
    with pytest.warns(UserWarning):
        assert L.label(people, study.limit(0)) is people


def test_labels_survive_parquet(spark, people, study, folder):
    L.label(people, study).write.parquet(folder + "/t")
    assert spark.read.parquet(folder + "/t").schema["stock"].metadata == {"label": "Root stock"}


def test_guard_skips_columns_without_codes(spark, study):
    df = spark.createDataFrame([(1, 7), (2, 8)], "record_id int, stock int")
    assert [r["stock"] for r in L.label(df, study).collect()] == [7, 8]
    assert L.label(df, study, guard="none").schema["stock"].dataType == T.StringType()


def test_mixed_codes_turn_a_numeric_column_to_text(spark):
    d = dictionary(spark, [("x", "f", "radio", "X", "1, One | abnormal, Odd")])
    df = spark.createDataFrame([(1,), (2,)], "x int").coalesce(1)
    assert [r["x"] for r in L.label(df, d).collect()] == ["One", "2"]
    raw = L.label(df, d, convert=False)
    assert raw.schema["x"].dataType == T.StringType()


def test_double_codes_compare_as_numbers(spark):
    d = dictionary(spark, [("x", "f", "radio", "X", "1, One | 2, Two")])
    df = spark.createDataFrame([(1.0,), (5.0,), (2.5,), (None,)], "x double").coalesce(1)
    assert [r["x"] for r in L.label(df, d).collect()] == ["One", "5", "2.5", None]


def test_long_code_list_is_joined(spark):
    codes = " | ".join(f"{i}, Label {i}" for i in range(1000))
    d = dictionary(spark, [("x", "f", "radio", "X", codes)])
    df = spark.range(0, 1500).select(F.col("id").cast("int").alias("x"))
    got = {r["x"] for r in L.label(df, d).collect()}
    assert got == {f"Label {i}" for i in range(1000)} | {str(i) for i in range(1000, 1500)}
    assert L.label(df, d).schema["x"].metadata == {"label": "X"}


def test_checkbox_names_without_digits(spark):
    d = dictionary(spark, [("meds", "f", "checkbox", "Meds", "asa, Aspirin")])
    df = spark.createDataFrame([(1,), (0,)], "meds___asa int").coalesce(1)
    assert [r[0] for r in L.label(df, d).collect()] == [1, 0]
    assert [r[0] for r in L.label(df, d, strict=False).collect()] == ["Aspirin", None]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.integers(0, 50),
        st.text(st.characters(codec="ascii", categories=["L"]), min_size=1, max_size=6),
        min_size=1,
        max_size=8,
    ).filter(lambda m: len(set(m.values())) == len(m))
)
def test_decode_then_encode_gives_the_codes_back(spark, mapping):
    d = dictionary(
        spark, [("x", "f", "radio", "X", " | ".join(f"{c}, {t}" for c, t in mapping.items()))]
    )
    codes = list(mapping)
    df = spark.createDataFrame([(c,) for c in codes], "x int").coalesce(1)
    back = {t: c for c, t in mapping.items()}
    assert [back[r["x"]] for r in L.label(df, d).collect()] == codes


def test_split(people, study):
    forms = split_forms(people, study)
    assert list(forms) == ["planting", "growth", "soil"]
    assert forms["planting"].columns == ["record_id", "grower", "plot", "stock"]
    assert forms["growth"].columns == ["record_id", "girth", "growth_complete"]
    assert forms["soil"].columns == ["record_id", "notes", "stock", "soil___1", "soil___2"]
    assert forms["soil"].count() == 5
    two = split_forms(people.filter("grower = 'Abara'"), study)
    assert {f.count() for f in two.values()} == {2}
    chosen = split_forms(people.select("record_id", "plot", "girth"), study)
    assert [len(f.columns) for f in chosen.values()] == [2, 2, 1]
    labelled = split_forms_labeled(people, study)
    assert labelled["planting"].schema["stock"].metadata == {"label": "Root stock"}
    assert split_forms(people, study, convert=True)["growth"].first()["growth_complete"] == "Complete"
    assert split_forms(people, None) == {"data": people}
    with pytest.raises(ValueError):
        single_form(forms)
    assert single_form({"data": people}) is people


def test_verbs(people, study):
    assert select_fields(people, "plot", "stock").columns == ["plot", "stock"]
    kept = select_fields(people, "plot", dictionary=study, keep_record_id=True)
    assert kept.columns == ["record_id", "plot"]
    below = arrange(below_group_mean(people, ["stock"], "girth"), "girth")
    assert [r["girth"] for r in below.collect()] == [18.75, 22.25]
    assert [r["plot"] for r in arrange(people, "plot").collect()][-1] is None
    assert [r["plot"] for r in arrange(people, "plot", descending=True).collect()][-1] is None
    assert record_id_name(study) == "record_id"


def test_column_families(spark, people, study):
    wide = people.select(
        "*", F.lit("s").alias("x_survey_identifier"), F.lit("g").alias("x_data_access_group")
    )
    assert project_families(wide, study).columns == people.columns
    both = project_families(wide, study, survey_fields=True, access_groups=True)
    assert both.columns == wide.columns
    assert project_fields(people, ["soil", "girth"], "record_id").columns == [
        "record_id", "soil___1", "soil___2", "girth",
    ]


def test_gray_status(spark, study):
    df = spark.createDataFrame(
        [(1, None, 0), (2, 20.0, 2)], "record_id int, girth double, growth_complete int"
    ).coalesce(1)
    shown = blank_gray_status(df, study, "record_id")
    assert [r["growth_complete"] for r in shown.collect()] == [None, 2]


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,0)", "decimal(20,2)", "int", "double"])
def test_codes_are_compared_exactly(spark, kind):
    base = 2**53 if kind in ("bigint", "decimal(38,0)") else 1000
    codes = [(str(base), "even"), (f"{base + 1}.0", "odd"), (str(base + 1), "second label"), ("0.5", "half"), ("1e3", "thousand")]
    df = spark.createDataFrame([(base,), (base + 1,), (base + 2,), (None,)], "v bigint").selectExpr(f"cast(v as {kind}) v")
    data_type = df.schema["v"].dataType
    got = [r[0] for r in df.select(L.decode(F.col("v"), data_type, codes)).collect()]
    assert got[:2] == ["even", "odd"] and got[2].startswith(str(base + 2)) and got[3] is None
    held = [r[0] for r in df.select(L.holds_code(F.col("v"), data_type, [c for c, _ in codes])).collect()]
    assert held == [True, True, False, None]
    only = [r[0] for r in df.select(L.holds_code(F.col("v"), data_type, ["0.25"])).collect()]
    assert not any(only)
    table = spark.createDataFrame([(base, "even", 1), (base + 1, "odd", 2), (base + 1, "later", 3)], "code bigint, label string, o int")
    for code_kind in ("bigint", "decimal(38,0)", "decimal(30,3)"):
        coded = table.selectExpr(f"cast(code as {code_kind}) code", "label", "o")
        out = [r[0] for r in L.decode_by_table(df, "v", coded, order="o").orderBy("v").collect()]
        assert [o for o in out if o in ("even", "odd")] == ["even", "odd"] and len(out) == 4


def test_long_lists_of_large_codes(spark):
    pairs = [(str(2**60 + i), f"label {i}") for i in range(300)]
    dictionary = spark.createDataFrame(
        [("v", "f", "radio", "V", " | ".join(f"{c}, {t}" for c, t in pairs))],
        "field_name string, form_name string, field_type string, field_label string, select_choices_or_calculations string",
    )
    df = spark.createDataFrame([(2**60 + i,) for i in range(305)], "v bigint")
    got = sorted(r["v"] for r in L.label(df, dictionary).collect())
    assert got == sorted([t for _, t in pairs] + [str(2**60 + i) for i in range(300, 305)])
