"""The command line jobs."""

from __future__ import annotations

import json

import pytest

from facetrank.__main__ import FILES, main
from facetrank.schemas import INPUTS
from facetrank.sinks import part_paths, write_delimited
from tests import micro
from tests.conftest import rows


def test_load_and_rank(spark, tmp_path):
    tables = micro.micro_tables(spark)
    for name, file in FILES.items():
        write_delimited(getattr(tables, name), str(tmp_path / file), header=INPUTS[name].header)
    main(["load", "--input", str(tmp_path), "--database", "jobs", "--buckets", "2"])
    main(["rank", "--database", "jobs"])
    assert rows(spark.table("jobs.top_genre")) == micro.TOP_GENRE
    assert rows(spark.table("jobs.best_director_for_genres")) == micro.FINAL
    spark.sql("DROP DATABASE jobs CASCADE")

    main(["report", "--input", str(tmp_path), "--output", str(tmp_path / "out")])
    lines = [tuple(r["value"].split("\t")) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines) == sorted(
        (c, g, str(mean), ",".join(names)) for c, g, mean, names in micro.FINAL_EXACT
    )


BODIES = {
    "t1": '{"Country":"USA, China"}',
    "t2": '{"Country":"N/A"}',
    "t3": "<p>oops\tt\nx</p>",
    "t4": '{"Country":"USA, China"}',
    "t5": '{"Country":"A\\tB\\nC"}',
}


def land(path, bodies) -> str:
    path.write_text("".join(json.dumps({"titleId": k, "body": v}) + "\n" for k, v in bodies.items()))
    return str(path)


def lines(spark, out, part):
    paths = part_paths(spark, out, part)
    return sorted(r["value"] for r in spark.read.text(paths).collect()) if paths else []


def test_countries(spark, tmp_path):
    out = str(tmp_path / "out")
    first = land(tmp_path / "first.jsonl", BODIES)
    for _ in range(2):  # the second adds nothing
        main(["countries", "--responses", first, "--output", out])
    once = ["t1\tUSA, China", "t2\t\\N", "t4\tUSA, China"]
    assert lines(spark, out, "countries") == once
    assert lines(spark, out, "values") == ["USA, China"]
    assert lines(spark, out, "single_values") == [" China", "USA"]
    rejects = [json.loads(x) for x in lines(spark, out, "rejects")]
    assert sorted(((r["titleId"], r.get("body"), r.get("countryText")) for r in rejects), key=repr) == sorted(
        [("t3", "<p>oops\tt\nx</p>", None), ("t5", None, "A\tB\nC")], key=repr
    )
    # A later run brings known titles again, with other countries, and a new one.
    more = land(tmp_path / "more.jsonl", {"t1": '{"Country":"Peru"}', "t6": '{"Country":"Chad"}'})
    main(["countries", "--responses", more, "--output", out])
    assert lines(spark, out, "countries") == [*once, "t6\tChad"]
    assert lines(spark, out, "values") == ["Chad", "USA, China"]


def test_a_run_that_dies_between_its_outputs_gives_each_row_once(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    source = land(tmp_path / "r.jsonl", BODIES)
    for dies_at in ("country_values", "commit_run"):
        with monkeypatch.context() as patch:

            def die(*args, **kwargs):
                raise RuntimeError("killed")

            patch.setattr(f"facetrank.__main__.{dies_at}", die)
            with pytest.raises(RuntimeError, match="killed"):
                main(["countries", "--responses", source, "--output", out])
        assert lines(spark, out, "countries") == []
    main(["countries", "--responses", source, "--output", out])
    assert lines(spark, out, "countries") == ["t1\tUSA, China", "t2\t\\N", "t4\tUSA, China"]
    assert lines(spark, out, "values") == ["USA, China"]
    assert len(lines(spark, out, "rejects")) == 2


def test_countries_run_twice_do_not_change_the_means(spark, tmp_path):
    """From landed responses to the ranks; every title is fetched and appended twice."""
    tables = micro.micro_tables(spark)
    for name, file in FILES.items():
        if name != "countries":
            write_delimited(getattr(tables, name), str(tmp_path / file), header=INPUTS[name].header)
    held = {}
    for r in tables.countries.collect():
        held.setdefault(r["titleId"], r["country"])
    source = tmp_path / "responses.jsonl"
    source.write_text(
        "".join(
            json.dumps({"titleId": k, "body": json.dumps({"Country": ",".join(v)} if v else {})}) + "\n"
            for k, v in held.items()
        )
    )
    results = []
    for _ in range(2):
        main(["countries", "--responses", str(source), "--output", str(tmp_path)])
        main(["load", "--input", str(tmp_path), "--database", "twice"])
        main(["rank", "--database", "twice"])
        results.append(rows(spark.table("twice.top_genre")))
    spark.sql("DROP DATABASE twice CASCADE")
    assert results[0] and results[0] == results[1]
