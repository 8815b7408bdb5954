import json

import pytest
from pyspark.sql import functions as F, types as T

from vitrine.operators.vectors import apply_model
from vitrine.plans import inputs, jobs
from vitrine.session import scratch_path
from vitrine.sources import index as index_io, requests as request_io, tables
from vitrine.streaming.scoring import score_stream


def test_csv_catalogue_keeps_odd_cells(spark):
    path = scratch_path(spark, "csv")
    rows = [
        ("s1", "a \"quoted\" name", "['line\none', 'x, y']", "[]"),
        ("s2", "b", "plain", "['Red']"),
    ]
    df = spark.createDataFrame(rows, "sku string, name string, fulldescription string, colorname string")
    tables.write_table(df.coalesce(1), path, "csv")
    back = tables.read_catalog(spark, path, "csv")
    assert back.columns == ["row_id", "name", "fulldescription", "colorname"]
    assert sorted(tuple(r)[1:] for r in back.collect()) == sorted(r[1:] for r in rows)
    assert back.select("row_id").distinct().count() == 2


@pytest.mark.parametrize("files", [1, 4])
def test_row_ids_follow_the_files(spark, files):
    """The first of equal descriptions is the first in the files, however the scan is cut."""
    path = scratch_path(spark, "ordered")
    for part in range(files):
        rows = [(f"n{i}", f"text {i % 10}", "[]") for i in range(part * 40 // files, (part + 1) * 40 // files)]
        df = spark.createDataFrame(rows, "name string, fulldescription string, colorname string").coalesce(1)
        tables.write_table(df, f"{path}/{part}", "csv")
    back = tables.read_catalog(spark, f"{path}/*", "csv")
    assert [r.name for r in back.orderBy("row_id").collect()] == [f"n{i}" for i in range(40)]
    assert back.agg(F.min("row_id"), F.max("row_id")).first() == (0, 39)


def test_missing_columns_and_files(spark):
    path = scratch_path(spark, "bad")
    spark.range(1).write.parquet(path)
    with pytest.raises(ValueError, match="lacks columns"):
        tables.read_features(spark, path)
    with pytest.raises(FileNotFoundError):
        tables.read_features(spark, path + "-absent")
    with pytest.raises(FileNotFoundError, match="build it first"):
        index_io.read_index(spark, path + "-absent")
    with pytest.raises(ValueError, match="lacks columns"):
        tables.read_table(spark, path).transform(
            lambda df: tables.require_columns(df, ["name"], "request table")
        )


def test_index_is_built_once(spark, small):
    path = scratch_path(spark, "once")
    features = inputs.features(spark, small)
    assert not index_io.index_exists(spark, path)
    rows, model = jobs.build_index(features, path, dim=32)
    before = rows.count()
    assert index_io.write_index(rows.limit(1), path, model) is False
    again, same = jobs.build_index(features.limit(1), path, dim=32)
    assert again.count() == before and same.idf == model.idf


def test_request_json(spark):
    bodies = [
        {"color": "x"},
        {"name": "  "},
        {"name": None},
        {"name": " Shoe ", "color": None, "top_k": None},
        {"name": "Hat", "color": " red ", "category": "hat", "top_k": 7},
        {"name": "Hat", "top_k": -1},
    ]
    rows = [(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(9, "not json"), (10, None)]
    df = spark.createDataFrame(rows, "query_id bigint, body string")
    accepted, rejected = request_io.parse_requests(df)
    assert sorted(tuple(r) for r in accepted.collect()) == [
        (3, "Shoe", "", "", 3), (4, "Hat", "red", "hat", 7),
    ]
    assert {r["query_id"]: r["error"] for r in rejected.collect()} == {
        0: "Missing required field: name",
        1: "Product name cannot be empty",
        2: "Product name cannot be empty",
        9: "Missing required field: name",
        10: "Missing required field: name",
        5: "top_k must be at least 1",
    }


def test_response_document(spark):
    df = spark.createDataFrame(
        [(1, "n", "c", "d", [(1, 5, "p", "red", 0.5)]), (2, "m", "", "", [])],
        "query_id bigint, name string, color string, description string, "
        "similar array<struct<rank:int,row_id:bigint,name_clean:string,colors_extracted:string,similarity_score:double>>",
    )
    got = {r[0]: json.loads(r[1]) for r in request_io.to_response(df).collect()}
    assert got[1] == {
        "name": "n", "color": "c", "description": "d",
        "similar_products": [{"name": "p", "color": "red", "score": 0.5}],
    }
    assert got[2]["similar_products"] == []


@pytest.fixture(scope="module")
def catalogue(spark, small):
    return inputs.index(spark, small)


def test_manual_requests(spark, catalogue):
    rows = [
        (1, "Running Shoes", "Black", "shoes", 3),
        (2, "Floral Maxi Dress", "Blue", "dress", 3),
        (3, "Leather Wallet", "", "", 3),
    ]
    asked = spark.createDataFrame(rows, "query_id bigint, name string, color string, category string, top_k int")
    echo = lambda df: df.withColumn("generated", F.concat("prompt", F.lit(" fine goods ")))
    answered = {r["query_id"]: r for r in jobs.recommend(asked, *catalogue, generate=echo).collect()}
    assert {i: r["description"] for i, r in answered.items()} == {i: "fine goods" for i in (1, 2, 3)}
    assert all(1 <= len(r["similar"]) <= 3 for r in answered.values())
    planned = {r["query_id"]: r for r in jobs.plan_batch(asked, *catalogue, generate=echo).collect()}
    assert [s["name"] for s in planned[1]["plan_trace"]] == ["PARSE", "RETRIEVE", "ENRICH", "GENERATE"]
    assert planned[1]["plan_trace"][3]["detail"] == "generated 2 tokens"
    assert planned[1]["color"] == "Black"


def test_walkthrough(spark, small):
    """CSV catalogue and requests in, index, answers with a model in the loop, CSV results out."""
    folder = scratch_path(spark, "walk")
    raw = inputs.raw_catalog(spark, small).drop("row_id")
    tables.write_table(raw, f"{folder}/catalogue", "csv")
    counts = jobs.ingest_catalog(tables.read_catalog(spark, f"{folder}/catalogue"), f"{folder}/features")
    assert counts["raw"] == raw.count() > counts["preprocessed"] > counts["features"] > 0
    features = tables.read_features(spark, f"{folder}/features")
    assert features.count() == counts["features"]
    index, model = jobs.build_index(features, f"{folder}/index")
    asked = spark.createDataFrame(
        [("Running Shoes", "Black"), ("  ", "Red"), ("Blue Bolt", None)], "name string, color string"
    )
    tables.write_table(asked, f"{folder}/requests", "csv")
    requests = request_io.read_requests(spark, f"{folder}/requests")
    assert requests.count() == 2

    def shouting():
        import numpy as np

        return lambda prompts: np.array([p + " " + p.split("\n")[0].upper() for p in prompts])

    def generate(df):
        return apply_model(df, "prompt", shouting, T.StringType(), out="generated")

    planned = jobs.plan_batch(requests, index, model, generate)
    request_io.write_results(planned, f"{folder}/results")
    got = {
        r["name"]: r for r in tables.read_table(spark, f"{folder}/results", "csv").na.fill("").collect()
    }
    assert got["Running Shoes"]["description"] == "PRODUCT: RUNNING SHOES"
    assert got["Running Shoes"]["color"] == "Black"
    assert got["Blue Bolt"]["top_similar"]
    answered = jobs.recommend(requests, index, model, generate, fewshot=True)
    assert all(r["description"].startswith("HERE ARE SIMILAR") for r in answered.collect())
    with pytest.raises(ValueError, match="lacks columns"):
        request_io.read_requests(spark, f"{folder}/features", "parquet")


@pytest.mark.parametrize("parts", [1, 16])
def test_partitioning_does_not_matter(spark, small, catalogue, parts):
    rows, model = catalogue
    asked = inputs.requests(spark, small)
    want = {r["query_id"]: r for r in jobs.recommend(asked, rows, model).collect()}
    moved = jobs.recommend(asked.repartition(parts), rows.repartition(parts), model)
    assert {r["query_id"]: r for r in moved.collect()} == want
    merged = lambda r: sorted(tuple(x) for x in jobs.hybrid_retrieve(asked, r, model, 3).collect())
    assert merged(rows.repartition(parts)) == merged(rows)


def test_features_do_not_depend_on_partitioning(spark, small):
    raw = inputs.raw_catalog(spark, small)
    want = sorted(tuple(r) for r in jobs.catalog_features(raw.coalesce(1)).collect())
    assert sorted(tuple(r) for r in jobs.catalog_features(raw.repartition(16)).collect()) == want


def test_stream_equals_batch_and_survives_replay(spark, small, catalogue):
    rows, model = catalogue
    folder = scratch_path(spark, "stream")
    bodies = inputs.request_bodies(spark, small)
    bodies.repartition(3).write.json(f"{folder}/in")

    def stream():
        return (
            spark.readStream.schema("query_id bigint, body string")
            .option("maxFilesPerTrigger", 1)
            .json(f"{folder}/in")
        )

    score_stream(stream(), rows, model, f"{folder}/out", f"{folder}/c1").awaitTermination()
    # a new checkpoint replays the same batches into the same folders
    score_stream(stream(), rows, model, f"{folder}/out", f"{folder}/c2").awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(f"{folder}/out/responses").select("query_id", "response").collect()}
    accepted, rejected = request_io.parse_requests(bodies)
    want = request_io.to_response(jobs.recommend(accepted, rows, model))
    assert got == {tuple(r) for r in want.collect()}
    assert spark.read.parquet(f"{folder}/out/rejected").count() == rejected.count()
    assert spark.read.parquet(f"{folder}/out/responses").count() == len(got)
