import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from packloom.cli import main
from packloom.operators import classify, contracts, schemas
from packloom.operators.schemas import unknown_columns
from packloom.settings import Settings, load_settings
from test_dictionary import ORDER, ROWS, write_xlsx


def test_tree(spark):
    nodes = spark.createDataFrame([("pack", None), ("doc", "pack"), ("page", "doc"), ("lost", "gone"), ("doc", "pack")], "node_id string, parent_id string")
    assert [r.node_id for r in contracts.orphans(nodes).collect()] == ["lost"]
    assert [r.node_id for r in contracts.repeated(nodes, "node_id").collect()] == ["doc"]
    assert ("page", "pack/doc/page", 2) in {tuple(r) for r in contracts.node_paths(nodes).collect()}


def test_telemetry(spark):
    calls = spark.createDataFrame([(120, 31, 7, Decimal("0.5")), (40, 9, 0, Decimal("0.125"))], "input_tokens long, output_tokens long, cached_tokens long, estimated_cost decimal(38,10)")
    r = contracts.telemetry_totals(calls).withColumn("c", contracts.cost_per_accepted(F.col("estimated_cost"), F.lit(5))).withColumn("n", contracts.cost_per_accepted(F.col("estimated_cost"), F.lit(0))).first()
    assert (r.input_tokens, r.output_tokens, r.cached_tokens, r.total_tokens) == (160, 40, 7, 200)
    assert r.estimated_cost == Decimal("0.625") and r.c == Decimal("0.125") and r.n is None


def test_checks(spark):
    df = spark.createDataFrame([(1, 0.5, 1, 2, "x"), (2, 1.5, 3, 2, " "), (3, None, 0, 0, None)], "id int, c double, a int, b int, t string")
    got = contracts.violations(df, "id", {"confidence": contracts.between_0_and_1(F.col("c")), "range": contracts.sound_range(F.col("a"), F.col("b")), "text": contracts.not_blank(F.col("t"))})
    assert sorted(map(tuple, got.collect())) == [(2, "confidence"), (2, "range"), (2, "text"), (3, "confidence"), (3, "range"), (3, "text")]
    assert unknown_columns(["a", "z"], ["a", "b"]) == ["z"]


def test_overrides_keep_the_first_label(spark):
    c = spark.createDataFrame([("s", "roofing"), ("t", "drainage")], "subject_id string, primary_label string")
    o = spark.createDataFrame([("s", "glazing")], "subject_id string, override_label string")
    assert {r.subject_id: (r.primary_label, r.effective_label) for r in classify.with_overrides(c, o).collect()} == {"s": ("roofing", "glazing"), "t": ("drainage", "drainage")}


@pytest.mark.parametrize(
    ("kind", "path", "label", "confidence"),
    [("zip", "maintenance.zip", "archive", 0.95), ("csv", "x/Matrix.csv", "equipment schedule", 0.85), ("pdf", "Certificat.pdf", "individual certificate", 0.8), ("pdf", "plant room.pdf", "drawing set", 0.78), ("text", "O&M.txt", "O&M manual", 0.72), ("pdf", "x.pdf", "unknown", 0.25), ("text", "x", "unknown", 0.1)],
)
def test_rules(spark, kind, path, label, confidence):
    got = spark.range(1).select(classify.label_of(F.lit(kind), F.lit(path)).alias("c")).first().c
    assert (got.primary_label, got.confidence) == (label, confidence)


def test_settings(tmp_path):
    f = tmp_path / "s.yaml"
    f.write_text("environment_name: test\nlog_level: debug\n")
    s = load_settings(str(f), {"PACKLOOM_ENVIRONMENT_NAME": "ci", "PACKLOOM_LOG_LEVEL": "", "PACKLOOM_API_KEY": "secret", "PACKLOOM_HOSTED_LLM_ENABLED": "Yes"})
    assert (s.environment_name, s.log_level, s.hosted_llm_enabled) == ("ci", "DEBUG", True)
    assert "secret" not in repr(s) and "secret" not in json.dumps(s.public())
    with pytest.raises(ValueError):
        Settings(log_level="CHATTY")
    f.write_text("nonsense: 1\n")
    with pytest.raises(ValueError, match="nonsense"):
        load_settings(str(f), {})


def test_cli(spark, tmp_path, capsys):
    book = write_xlsx(tmp_path / "d.xlsx", {"Extraction Template": [ORDER, *ROWS]})
    out = str(tmp_path / "out")
    assert main(["dictionary", "validate", "--dictionary-path", book, "--output-dir", out], spark) == 4
    assert main(["dictionary", "validate", "--dictionary-path", write_xlsx(tmp_path / "ok.xlsx", {"s": [ORDER, ROWS[0]]}), "--output-dir", out], spark) == 0
    assert main(["dictionary", "validate", "--dictionary-path", write_xlsx(tmp_path / "no.xlsx", {"s": [["x"], ["y"]]}), "--output-dir", out], spark) == 2
    assert main(["dictionary", "inspect", "--dictionary-path", book], spark) == 0
    assert main(["extract", "--dictionary-path", book, "--asset-config", "x", "--output-dir", out]) == 3
    assert main(["config-check"]) == 0
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.txt").write_text("x")
    assert main(["sources", "inspect", "--source-path", str(tmp_path / "p")], spark) == 0
    assert main(["sources", "ingest", "--source-path", str(tmp_path / "p"), "--output-dir", out, "--max-archive-depth", "0"], spark) == 0
    with pytest.raises(SystemExit):
        main(["dictionary", "inspect", "--dictionary-path", book, "--header-row", "0"], spark)
    capsys.readouterr()


def test_records(spark):
    """Each record's text is a type, and a strict table of it can be made."""
    records = {k: v for k, v in vars(schemas).items() if isinstance(v, str) and v.startswith("struct<")}
    assert len(records) >= 16
    for text in records.values():
        assert schemas.table_of(spark, text).columns == [f.name for f in schemas.fields(text).fields]
    score = schemas.table_of(spark, schemas.RETRIEVAL_SCORE, [("i", 0.5, "s", None)])
    assert contracts.violations(score, "item_id", {"score": contracts.between_0_and_1(F.col("score"))}).count() == 0
    assert schemas.fields(schemas.VALIDATION_RESULT).names[3:12] == [f"{c}_result" for c in schemas.VALIDATION_CHECKS]


def test_capability(spark):
    """A capability maps bundles to candidates; one without that can't be made."""

    class Echo(contracts.Capability):
        capability_id, version, supported_evidence_types = "echo", "1", frozenset({"text"})

        def extract(self, bundles):
            return bundles.select("target_row_id", F.lit(self.capability_id).alias("capability_id"), F.to_json("units").alias("candidate_value"), F.lit(1.0).alias("confidence"))

    bundles = contracts.bundles(spark.createDataFrame([("t", 2, "b"), ("t", 1, "a")], "target_row_id string, pos int, text string"), "target_row_id", "pos", ["text"])
    got = Echo().extract(bundles)
    assert [json.loads(r.candidate_value) for r in got.collect()] == [[{"pos": 1, "text": "a"}, {"pos": 2, "text": "b"}]]
    assert unknown_columns(got.columns, schemas.fields(Echo.output_schema).names) == []
    with pytest.raises(TypeError):
        contracts.Capability()


def test_trees_of_any_depth_and_cycles(spark):
    """A chain of 5,000 nodes, a cycle with a tail, a node that is its own parent, one below a missing node, and a repeated row."""
    pairs = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(5000)] + [(f"o{i}", f"o{(i + 1) % 7}") for i in range(7)] + [("t0", "o3"), ("t1", "t0"), ("self", "self"), ("lost", "nowhere"), ("below", "lost"), ("alone", ""), ("c1", "c0")]
    nodes = spark.createDataFrame(pairs, "node_id string, parent_id string").repartition(4)
    got = contracts.node_paths(nodes).select("node_id", F.length("path").alias("n"), "depth", F.right("path", F.lit(11)).alias("end")).collect()
    assert {r.node_id: r.depth for r in got} == {f"c{i}": i for i in range(5000)} | {"alone": 0} and len(got) == 5001
    last = next(r for r in got if r.node_id == "c4999")
    assert last.n == sum(len(f"c{i}") + 1 for i in range(5000)) - 1 and last.end == "c4998/c4999"
    assert {r.node_id for r in contracts.cycles(nodes).collect()} == {f"o{i}" for i in range(7)} | {"self"}
    assert {tuple(r) for r in contracts.orphans(nodes).collect()} == {("lost", "nowhere")}
    none = nodes.limit(0)
    assert not contracts.node_paths(none).count() and not contracts.cycles(none).count()
