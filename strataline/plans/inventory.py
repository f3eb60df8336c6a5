"""Queries over tracks, names, splits and manifests."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.functions import checkpoints, geometry, names, schedules, vectors
from strataline.operators import constraints, curate, profile, sampling
from strataline.plans import fixtures as fx
from strataline.plans.fixtures import given
from strataline.schema import GALLERY, JUNK, QUERY, TRAIN
from strataline.session import shared_dir
from strataline.sources import files, listings, sinks, tables, tracks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


C = F.col
FLOORS = geometry.CropFloors()
# --- sources -------------------------------------------------------------------------------------------------


@query("sc1_track_scan", given("boxes") + "SELECT position, frame, tid, x, y, w, h, vis, cls FROM boxes WHERE position % 11 <> 0")
def sc1(s, d):
    return tracks.parsed(fx.track_lines(s, d), strict=False)


@query("sc2_malformed_lines", given("boxes") + "SELECT position, frame || ',' || tid || ',' || x || ',' || y || ',' || w AS value, CAST(5 AS BIGINT) AS n_fields FROM boxes WHERE position % 11 = 0")
def sc2(s, d):
    return tracks.malformed(fx.track_lines(s, d))


_IMAGE = "regexp_matches(lower(name), '\\.(jpg|jpeg|png)$')"
_PID, _CAM = "CAST(regexp_extract(name, '^(-?[0-9]+)_c([0-9]+)', 1) AS BIGINT)", "CAST(regexp_extract(name, '^(-?[0-9]+)_c([0-9]+)', 2) AS BIGINT)"
_OK = "regexp_matches(name, '^(-?[0-9]+)_c([0-9]+)')"


@query("sc3_strict_listing", given("listing") + f"SELECT position, name, {_PID} AS pid, {_CAM} AS camid FROM listing WHERE {_IMAGE} AND position % 101 <> 0")
def sc3(s, d):
    return listings.strict(fx.listing(s, d).filter("position % 101 <> 0"))


@query("sc4_lenient_listing", given("listing") + f"SELECT position, name, CASE WHEN {_OK} THEN {_PID} END AS pid, CASE WHEN {_OK} THEN {_CAM} END AS camid, {_OK} AS ok FROM listing WHERE {_IMAGE}".replace("CAST(reg", "TRY_CAST(reg"))
def sc4(s, d):
    return listings.lenient(fx.listing(s, d))


@query("sc5_loader_listing", given("listing") + f"SELECT position, name, {_PID} AS pid, {_CAM} AS camid, right(name, 4) AS kind FROM listing WHERE regexp_matches(name, '\\.(jpg|png)$') AND position % 101 <> 0 ORDER BY kind, name")
def sc5(s, d):
    return listings.loader(fx.listing(s, d).filter("position % 101 <> 0"))


@query("sc6_dataset_load", given("source_rows") + f"""SELECT source, split, pid, camid, file, CASE WHEN split = '{TRAIN}' THEN dense_rank() OVER (PARTITION BY split ORDER BY pid) - 1 END AS label
    FROM source_rows WHERE split <> '{TRAIN}' OR pid <> -1""")
def sc6(s, d):
    return listings.labelled_train(fx.source_rows(s, d)).select("source", "split", "pid", "camid", "file", "label")


@query("sc7_decisions_last_wins", given("decisions") + "SELECT pid, CASE WHEN pid % 3 = 0 THEN 'keep' ELSE action END AS action FROM decisions")
def sc7(s, d):
    first = fx.decisions(s, d).withColumn("position", C("pid"))
    again = first.filter("pid % 3 = 0").withColumn("action", F.lit(" keep ")).withColumn("position", C("pid") + 1_000_000_000)
    return tables.last_wins(first.unionByName(again).withColumn("action", F.trim("action")), "pid", "action", "position")


@query("sc8_scores_last_wins", given("boxes") + "SELECT tid || '.jpg' AS file, max_by(vis, position) AS self_sim FROM boxes GROUP BY tid")
def sc8(s, d):
    rows = fx.boxes(s, d).select(F.concat(C("tid").cast("string"), F.lit(".jpg")).alias("file"), C("vis").alias("self_sim"), "position")
    return tables.last_wins(rows, "file", "self_sim", "position")


# A recipe for each nation, as in a file for each build: its customers are the sources, some without a word on evaluation.
@query("sc9_recipe", """SELECT 'nation ' || c_nationkey AS recipe, c_name AS name, 'c' || c_custkey AS tag, 1000 * c_custkey AS pid_offset, 10 * c_custkey AS cam_offset, c_custkey % 3 = 0 OR c_custkey % 2 = 0 AS use_eval FROM customer""")
def sc9(s, d):
    k = C("c_custkey")
    source = F.struct(C("c_name").alias("name"), F.concat(F.lit("c"), k.cast("string")).alias("tag"), (1000 * k).alias("pid_offset"), (10 * k).alias("cam_offset"), F.when(k % 3 != 0, k % 2 == 0).alias("use_eval"))
    docs = fx.table(s, d, "customer").groupBy("c_nationkey").agg(F.collect_list(source).alias("sources"))
    text = docs.select(F.to_json(F.struct(F.concat(F.lit("nation "), C("c_nationkey").cast("string")).alias("name"), "sources")).alias("value"))
    return tables.recipe_sources(text)


@query("sc10_coco_annotations", given("truth") + "SELECT gt_id, image_id, category_id, x, y, w, h, CAST(0 AS INTEGER) AS iscrowd FROM truth")
def sc10(s, d):
    one = F.struct(C("gt_id").alias("id"), "image_id", "category_id", F.array("x", "y", "w", "h").alias("bbox"))
    # a document for each image, as in a file for each video
    docs = fx.truth(s, d).groupBy("image_id").agg(F.collect_list(one).alias("annotations")).select(F.to_json(F.struct("annotations")).alias("value"))
    return tables.coco_annotations(docs)


@query("sc10_coco_images", given("truth") + "SELECT DISTINCT image_id, image_id || '.jpg' AS file_name FROM truth")
def sc10_images(s, d):
    image = F.struct(C("image_id").alias("id"), F.concat(C("image_id").cast("string"), F.lit(".jpg")).alias("file_name"))
    docs = fx.truth(s, d).select("image_id").distinct().select(F.to_json(F.struct(F.array(image).alias("images"))).alias("value"))
    return tables.coco_images(docs)


@query("sc14_prediction_listing", given("listing") + "SELECT position, name FROM listing WHERE regexp_matches(lower(name), '\\.(jpg|jpeg|png|bmp|webp)$') ORDER BY name")
def sc14(s, d):
    return listings.prediction_sources(fx.listing(s, d))


# --- sinks ---------------------------------------------------------------------------------------------------


@query("sk1_layout_counts", given("crops") + "SELECT split, count(*) AS crops FROM crops GROUP BY split")
def sk1(s, d):
    return sinks.split_counts(fx.crops(s, d))


# Written as files and read back: what each crop holds is its identity and camera.
@query("sk1_written_layout", given("crops") + "SELECT split AS folder, count(*) AS files, CAST(sum(length(pid || ',' || camid)) AS BIGINT) AS bytes FROM crops GROUP BY split")
def sk1_written(s, d):
    path = f"{shared_dir(s)}/layout-{uuid.uuid4().hex}"
    crops = fx.crops(s, d).select("split", "pid", "camid", C("path").alias("name"), F.concat_ws(",", C("pid").cast("string"), C("camid").cast("string")).cast("binary").alias("content"))
    sinks.write_layout_files(crops, path, strict=False)
    return files.read_files(s, path).groupBy("folder").agg(F.count("*").alias("files"), F.sum(F.octet_length("content")).alias("bytes"))


_MANIFEST_COLUMNS = "file, split, source, pid, camid, orig_pid, orig_camid, orig_file"


def manifest(s, d):
    return curate.combined(fx.source_rows(s, d), tables.recipe(s, fx.RECIPE)[1])


@query("sk2_manifest", given("manifest") + f"SELECT {_MANIFEST_COLUMNS} FROM manifest")
def sk2(s, d):
    return manifest(s, d)


@query("sk3_score_rows", given("boxes") + "SELECT tid || '.jpg' AS file, vis AS self_sim FROM boxes ORDER BY file, self_sim")
def sk3(s, d):
    return sinks.score_rows(fx.boxes(s, d).select(F.concat(C("tid").cast("string"), F.lit(".jpg")).alias("file"), C("vis").alias("self_sim")))


@query("sk4_feature_index", given("crops") + "SELECT path, len(embedding) AS width, round(embedding[1], 6) AS first FROM crops")
def sk4(s, d):
    return fx.crops(s, d).select("path", F.size("embedding").cast("bigint").alias("width"), F.round(F.element_at("embedding", 1).cast("double"), 6).alias("first"))


@query("sk5_readme_statistics", given("manifest") + "SELECT split, count(*) AS crops, count(DISTINCT CASE WHEN pid <> -1 THEN pid END) AS identities, count(*) FILTER (WHERE pid = -1) AS junk, count(DISTINCT camid) AS cameras FROM manifest GROUP BY split")
def sk5(s, d):
    return profile.by_split(manifest(s, d)).drop("camera_list")


@query("sk5_composition", given("manifest") + """, w AS (SELECT count(DISTINCT pid) AS whole FROM manifest WHERE split = '{t}' AND pid <> -1),
    g AS (SELECT source, count(DISTINCT CASE WHEN split = '{t}' AND orig_pid <> -1 THEN orig_pid END) AS train_ids, count(*) FILTER (WHERE split = '{t}') AS train_crops, count(DISTINCT CASE WHEN split = '{q}' AND orig_pid <> -1 THEN orig_pid END) AS eval_ids,
    count(*) FILTER (WHERE split = '{q}') AS query_crops, count(*) FILTER (WHERE split NOT IN ('{t}', '{q}')) AS gallery_crops FROM manifest GROUP BY source)
    SELECT source, CASE WHEN source = 'supplier' THEN 1000000 ELSE 0 END::BIGINT AS pid_offset, CASE WHEN source = 'supplier' THEN 100 ELSE 0 END::BIGINT AS cam_offset, source = 'customer' AS use_eval, train_ids, train_crops, eval_ids, query_crops, gallery_crops,
    round(100.0 * train_ids / greatest(whole, 1), 4) AS percent, greatest(CAST(round_even(whole / greatest(train_ids, 1), 0) AS BIGINT), 1) AS one_in FROM g, w""".replace("{t}", TRAIN).replace("{q}", QUERY))
def sk5_composition(s, d):
    return profile.composition(manifest(s, d), tables.recipe(s, fx.RECIPE)[1])


@query("sk7_contact_rows", given("crops") + "SELECT camid, path, place FROM (SELECT camid, path, row_number() OVER (PARTITION BY camid ORDER BY path) AS place FROM crops) WHERE place <= 24")
def sk7(s, d):
    return sinks.contact_rows(fx.crops(s, d)).select("camid", "path", C("place").cast("bigint").alias("place"))


# --- scalar functions ----------------------------------------------------------------------------------------


@query("fn1_crop_name", given("boxes") + "SELECT position, format('{}_c{}_s{:02d}_f{:06d}.jpg', tid, camera, sequence, frame) AS name FROM boxes")
def fn1(s, d):
    return fx.boxes(s, d).select("position", names.crop_name(C("tid"), C("camera"), C("sequence"), C("frame")).alias("name"))


@query("fn2_parse_name", given("listing") + f"SELECT position, CASE WHEN {_OK} THEN {_PID} END AS pid, CASE WHEN {_OK} THEN {_CAM} END AS camid FROM listing".replace("CAST(reg", "TRY_CAST(reg"))
def fn2(s, d):
    return fx.listing(s, d).select("position", names.pid_of(C("name")).alias("pid"), names.cam_of(C("name")).alias("camid"))


@query("fn3_combined_name", given("listing") + "SELECT position, position || '_c1_tag_' || regexp_replace(name, '\\.[^.]+$', '') || '.jpg' AS name FROM listing")
def fn3(s, d):
    return fx.listing(s, d).select("position", names.combined_name(C("position"), F.lit(1), F.lit("tag"), C("name")).alias("name"))


@query("fn4_remap_ids", given("source_rows") + "SELECT source, file, CASE WHEN pid = -1 THEN -1 ELSE pid + 5000 END AS pid, camid + 7 AS camid FROM source_rows")
def fn4(s, d):
    return fx.source_rows(s, d).select("source", "file", names.remapped_pid(C("pid"), F.lit(5000)).alias("pid"), (C("camid") + 7).alias("camid"))


@query("fn5_resolve_decision", given("decisions") + "SELECT pid, action, CASE WHEN action = 'keep' THEN pid WHEN action = 'drop' THEN NULL ELSE CAST(substr(action, 7) AS BIGINT) END AS resolved FROM decisions")
def fn5(s, d):
    return fx.decisions(s, d).withColumn("resolved", curate.resolved(C("pid"), C("action")))


@query("fn6_route_split", given("crops") + "SELECT vec_id, pid, camid, split FROM crops")
def fn6(s, d):
    return fx.crops(s, d).select("vec_id", "pid", "camid", "split")


@query("fn7_crop_rectangle", given("boxes") + """, r AS (SELECT position, greatest(0, CAST(trunc(x - w * 0.08) AS BIGINT)) AS l, greatest(0, CAST(trunc(y - h * 0.08) AS BIGINT)) AS t,
    least(1920, CAST(trunc(x + w + w * 0.08) AS BIGINT)) AS r, least(1080, CAST(trunc(y + h + h * 0.08) AS BIGINT)) AS b FROM boxes)
    SELECT position, CAST(l AS BIGINT) AS "left", CAST(t AS BIGINT) AS top, CAST(greatest(l, r) AS BIGINT) AS "right", CAST(greatest(t, b) AS BIGINT) AS bottom FROM r""")
def fn7(s, d):
    return fx.boxes(s, d).select("position", *[c.cast("bigint").alias(n) for c, n in zip(geometry.crop_rectangle(C("x"), C("y"), C("w"), C("h"), 1920, 1080), ("left", "top", "right", "bottom"), strict=True)])


def _first(v, n=4):
    return [F.round(F.element_at(v, k + 1), 6).alias(f"v{k}") for k in range(n)]


_NORM = "sqrt(list_sum(list_transform(embedding, lambda v: v * v)))"


@query("fn8_normalise_eps", given("crops") + f"SELECT vec_id, {', '.join(f'round(embedding[{k + 1}] / ({_NORM} + 1e-9), 6) AS v{k}' for k in range(4))} FROM crops")
def fn8(s, d):
    return fx.crops(s, d).select("vec_id", vectors.normalised("embedding").alias("v")).select("vec_id", *_first("v"))


@query("fn9_normalise", given("crops") + f"SELECT vec_id, {', '.join(f'round(embedding[{k + 1}] / {_NORM}, 6) AS v{k}' for k in range(4))} FROM crops")
def fn9(s, d):
    return fx.crops(s, d).select("vec_id", vectors.normalised("embedding", 0).alias("v")).select("vec_id", *_first("v"))


@query("fn10_mirror_sum", given("crops") + f"SELECT vec_id, {', '.join(f'round(embedding[{k + 1}] + embedding[{64 - k}], 6) AS v{k}' for k in range(4))} FROM crops")
def fn10(s, d):
    return fx.crops(s, d).select("vec_id", vectors.added(C("embedding"), F.reverse("embedding")).alias("v")).select("vec_id", *_first("v"))


@query("fn11_cosine_distance", given("crops") + "SELECT a.vec_id AS a, b.vec_id AS b, round(1 - list_sum(list_transform(range(1, 65), lambda k: a.embedding[k] * b.embedding[k])), 6) AS dist FROM crops a JOIN crops b ON b.vec_id = a.vec_id + 1")
def fn11(s, d):
    a = fx.crops(s, d).select(C("vec_id").alias("a"), C("embedding").alias("x"))
    b = fx.crops(s, d).select((C("vec_id") - 1).alias("a"), C("vec_id").alias("b"), C("embedding").alias("y"))
    return a.join(b, "a").select("a", "b", F.round(vectors.cosine_distance("x", "y"), 6).alias("dist"))


@query("fn12_box_from_corners", given("boxes") + "SELECT position, x, y, (x + w) - x AS w, (y + h) - y AS h FROM boxes")
def fn12(s, d):
    box = geometry.xywh(C("x"), C("y"), C("x") + C("w"), C("y") + C("h"))
    return fx.boxes(s, d).select("position", *[F.element_at(box, k + 1).alias(n) for k, n in enumerate("xywh")])


@query("fn13_category", given("boxes") + "SELECT position, CAST(3 AS BIGINT) AS lone, CAST(cls + 1 AS BIGINT) AS zero, CAST(cls + 1 AS BIGINT) AS several FROM boxes")
def fn13(s, d):
    return fx.boxes(s, d).select("position", geometry.category_of(C("cls"), [3]).alias("lone"), geometry.category_of(C("cls"), [0]).alias("zero"), geometry.category_of(C("cls"), [1, 2]).alias("several"))


@query("fn14_prune", given("boxes") + "SELECT position, coalesce(score < 0.1, false) AS pruned, false AS off FROM (SELECT position, CASE WHEN position % 7 <> 0 THEN vis END AS score FROM boxes)")
def fn14(s, d):
    score = F.when(C("position") % 7 != 0, C("vis"))
    return fx.boxes(s, d).select("position", vectors.is_pruned(score, 0.1).alias("pruned"), vectors.is_pruned(score, 0).alias("off"))


@query("fn15_cosine_rate", """SELECT event_id, round(CASE WHEN e < 20 THEN 4e-6 + e * (4e-4 - 4e-6) / 20 WHEN e >= 120 THEN 8e-7 ELSE 8e-7 + 0.5 * (4e-4 - 8e-7) * (1 + cos(pi() * e / 120)) END, 12) AS rate FROM (SELECT event_id, event_id % 131 AS e FROM events)""")
def fn15(s, d):
    return fx.table(s, d, "events").select("event_id", F.round(schedules.cosine_rate(C("event_id") % 131, 4e-4, 120, 20), 12).alias("rate"))


@query("fn16_step_rate", "SELECT event_id, round(CASE WHEN i < 50 THEN 0.05 * (i + 1) / 50 ELSE 0.05 * pow(0.1, ((1 + i // 10) - 1) // 40) END, 12) AS rate FROM (SELECT event_id, event_id % 1000 AS i FROM events)")
def fn16(s, d):
    i = C("event_id") % 1000
    return fx.table(s, d, "events").select("event_id", F.round(schedules.step_rate(1 + F.floor(i / 10), i, 0.05, 10, 5, 40, 0.1), 12).alias("rate"))


@query("fn17_shares", "SELECT s_suppkey, round(100.0 * s_nationkey / greatest(s_suppkey, 1), 4) AS percent, greatest(CAST(round_even(s_suppkey / greatest(s_nationkey, 1), 0) AS BIGINT), 1) AS one_in, s_suppkey // 64 AS steps FROM supplier")
def fn17(s, d):
    k, n = C("s_suppkey"), C("s_nationkey")
    return fx.table(s, d, "supplier").select("s_suppkey", F.round(schedules.percent(n, k), 4).alias("percent"), schedules.one_in(k, n).alias("one_in"), F.floor(k / 64).cast("bigint").alias("steps"))


def _state(s, d):
    """Checkpoint metadata, with keys made of the events."""
    e = C("event_id")
    key = F.when(e == 0, "base.cls_token").when(e == 1, "base.patch_embed.proj.weight").when(e % 5 == 0, F.concat(F.lit("classifier."), e.cast("string"))).when(e % 5 == 1, F.concat(F.lit("bottleneck."), e.cast("string"))).otherwise(F.concat(F.lit("base.blocks."), (e % 12).cast("string"), F.lit("."), e.cast("string")))
    return fx.table(s, d, "events").select(key.alias("key"), F.array(F.lit(1).cast("bigint"), 16 + e % 4).alias("shape"))


_STATE = """WITH state AS (SELECT CASE WHEN event_id = 0 THEN 'base.cls_token' WHEN event_id = 1 THEN 'base.patch_embed.proj.weight' WHEN event_id % 5 = 0 THEN 'classifier.' || event_id
    WHEN event_id % 5 = 1 THEN 'bottleneck.' || event_id ELSE 'base.blocks.' || (event_id % 12) || '.' || event_id END AS key, 16 + event_id % 4 AS width FROM events) """


@query("fn18_split_checkpoint", _STATE + """SELECT CASE WHEN starts_with(key, 'base.') THEN 'backbone' ELSE 'neck' END AS "group", regexp_replace(key, '^(base|bottleneck)\\.', '') AS key, width FROM state WHERE NOT starts_with(key, 'classifier')""")
def fn18(s, d):
    return checkpoints.split_keys(_state(s, d), ("classifier",)).select("group", "key", F.element_at("shape", -1).alias("width"))


@query("fn19_architecture", _STATE + "SELECT CAST(16 AS BIGINT) AS embed_dim, 1 + max(CAST(split_part(key, '.', 3) AS BIGINT)) AS depth, CAST(17 AS BIGINT) AS patch_size FROM state WHERE starts_with(key, 'base.blocks.')")
def fn19(s, d):
    rows = checkpoints.split_keys(_state(s, d), ("classifier",)).filter(C("group") == "backbone")
    return checkpoints.architecture(rows)


@query("fn20_token_count", "SELECT p_partkey, CAST(1 + (256 // p_size) * (128 // p_size) AS BIGINT) AS tokens FROM part WHERE p_size > 0")
def fn20(s, d):
    return fx.table(s, d, "part").filter("p_size > 0").select("p_partkey", checkpoints.token_count(256, 128, C("p_size")).cast("bigint").alias("tokens"))


@query("fn21_reprefix", _STATE + "SELECT 'model.' || substr(key, 6) AS key, width FROM state WHERE starts_with(key, 'base.')")
def fn21(s, d):
    return checkpoints.reprefixed(_state(s, d), "base.", "model.").select("key", F.element_at("shape", -1).alias("width"))


# --- filters -------------------------------------------------------------------------------------------------

_SMALL, _HIDDEN = "(w < 32 OR h < 80)", "(vis < 0.65)"
_EDGE = "(x <= 2 OR y <= 2 OR x + w >= 1918 OR y + h >= 1078)"


@query("fi1_size_floor", given("boxes") + f"SELECT position FROM boxes WHERE NOT {_SMALL}")
def fi1(s, d):
    return fx.boxes(s, d).filter(~FLOORS.too_small(C("w"), C("h"))).select("position")


@query("fi2_visibility_floor", given("boxes") + f"SELECT position FROM boxes WHERE NOT {_HIDDEN}")
def fi2(s, d):
    return fx.boxes(s, d).filter(~FLOORS.too_hidden(C("vis"))).select("position")


@query("fi3_edge_floor", given("boxes") + f"SELECT position FROM boxes WHERE NOT {_EDGE}")
def fi3(s, d):
    return fx.boxes(s, d).filter(~FLOORS.at_edge(C("x"), C("y"), C("w"), C("h"))).select("position")


def accepted(s, d):
    return fx.boxes(s, d).filter(FLOORS.accepts(C("x"), C("y"), C("w"), C("h"), C("vis")))


_ACCEPTED = f"NOT {_SMALL} AND NOT {_HIDDEN} AND NOT {_EDGE}"


@query("fi_accepts", given("boxes") + f"SELECT position, sequence, camera, tid, frame FROM boxes WHERE {_ACCEPTED}")
def fi_accepts(s, d):
    return accepted(s, d).select("position", "sequence", "camera", "tid", "frame")


@query("fi4_no_junk", given("source_rows") + "SELECT source, file FROM source_rows WHERE pid <> -1")
def fi4(s, d):
    return fx.source_rows(s, d).filter(C("pid") != JUNK).select("source", "file")


@query("fi7_image_suffix", given("listing") + f"SELECT position, name FROM listing WHERE {_IMAGE}")
def fi7(s, d):
    return fx.listing(s, d).filter(names.has_suffix(C("name"), listings.STRICT_SUFFIXES)).select("position", "name")


@query("fi9_participating", given("source_rows") + f"SELECT source, split, file FROM source_rows WHERE split = '{TRAIN}' OR source = 'customer'")
def fi9(s, d):
    return manifest(s, d).select("source", "split", C("orig_file").alias("file"))


@query("fi10_source_prefix", given("manifest") + "SELECT file FROM manifest WHERE starts_with(source, 'supp')")
def fi10(s, d):
    return manifest(s, d).filter(C("source").startswith("supp")).select("file")


@query("fi11_person_class", given("boxes") + "SELECT position FROM boxes WHERE cls = 1")
def fi11(s, d):
    return fx.boxes(s, d).filter("cls = 1").select("position")


@query("fi12_degenerate", given("boxes") + "SELECT position, (h < 64 OR w < 24) AS degenerate FROM boxes")
def fi12(s, d):
    return fx.boxes(s, d).select("position", geometry.is_degenerate(C("w"), C("h")).alias("degenerate"))


# --- joins ---------------------------------------------------------------------------------------------------


@query("jn1_decision_lookup", given("boxes", "decisions") + "SELECT b.position, CASE WHEN d.action IS NULL OR d.action = 'keep' THEN b.tid WHEN d.action = 'drop' THEN NULL ELSE CAST(substr(d.action, 7) AS BIGINT) END AS resolved FROM boxes b LEFT JOIN decisions d ON b.tid = d.pid")
def jn1(s, d):
    rows = fx.boxes(s, d).withColumnRenamed("tid", "pid")
    return curate.decided(rows, fx.decisions(s, d)).select("position", "resolved")


@query("jn2_score_lookup", given("boxes") + ", sc AS (SELECT position || '.jpg' AS file, vis AS self_sim FROM boxes WHERE position % 3 = 0) SELECT position, self_sim, coalesce(self_sim < 0.1, false) AS pruned FROM boxes LEFT JOIN sc ON position || '.jpg' = file")
def jn2(s, d):
    rows = fx.boxes(s, d).withColumn("file", F.concat(C("position").cast("string"), F.lit(".jpg")))
    scores = rows.filter("position % 3 = 0").select("file", C("vis").alias("self_sim"))
    return curate.scored(rows.select("position", "file"), scores).select("position", "self_sim", vectors.is_pruned(C("self_sim"), 0.1).alias("pruned"))


@query("jn3_crops_by_frame", given("boxes") + f"SELECT f.video, f.frame, b.position FROM (SELECT DISTINCT camera AS video, frame FROM boxes WHERE frame % 3 = 0) f JOIN boxes b ON b.camera = f.video AND b.frame = f.frame WHERE {_ACCEPTED}")
def jn3(s, d):
    from strataline.operators import encoders

    frames = fx.boxes(s, d).filter("frame % 3 = 0").select(C("camera").alias("video"), "frame").distinct()
    return encoders.crops_by_frame(frames, accepted(s, d).select(C("camera").alias("video"), "frame", "position")).select("video", "frame", "position")


@query("jn12_source_offsets", given("manifest") + "SELECT file, pid, camid FROM manifest")
def jn12(s, d):
    return manifest(s, d).select("file", "pid", "camid")


@query("jn13_labels", given("source_rows") + f"SELECT source, file, dense_rank() OVER (ORDER BY pid) - 1 AS label FROM source_rows WHERE split = '{TRAIN}' AND pid <> -1")
def jn13(s, d):
    train = fx.source_rows(s, d).filter((C("split") == TRAIN) & (C("pid") != JUNK))
    return train.join(listings.contiguous(train, "pid"), "pid").select("source", "file", "label")


@query("jn14_camera_index", given("manifest") + f""", known AS (SELECT camid, dense_rank() OVER (ORDER BY camid) - 1 AS i FROM (SELECT DISTINCT camid FROM manifest WHERE split = '{TRAIN}' AND source = 'supplier'))
    SELECT file, split, coalesce(i, (SELECT count(*) FROM known)) AS cam_index FROM manifest LEFT JOIN known USING (camid)""")
def jn14(s, d):
    rows = manifest(s, d)
    return curate.camera_index(rows, rows.filter((C("split") == TRAIN) & (C("source") == "supplier"))).select("file", "split", "cam_index")


@query("jn15_warm_start", _STATE + "SELECT key, starts_with(key, 'base.') AND width <> 19 AS loaded FROM state")
def jn15(s, d):
    own = _state(s, d)
    given_state = own.filter(C("key").startswith("base.")).select("key", F.when(F.element_at("shape", -1) == 19, F.array(F.lit(0).cast("bigint"))).otherwise(C("shape")).alias("shape"))
    return checkpoints.warm_start(own, given_state)


# --- aggregates ----------------------------------------------------------------------------------------------


@query("ag1_crop_counts", given("manifest") + "SELECT source, split, count(*) AS crops, CAST(grouping(source) AS BIGINT) AS all_sources FROM manifest GROUP BY GROUPING SETS ((source, split), (split))")
def ag1(s, d):
    return profile.counts(manifest(s, d))


@query("ag2_identities", given("source_rows") + "SELECT split, count(DISTINCT CASE WHEN pid <> -1 THEN pid END) AS identities FROM source_rows GROUP BY split")
def ag2(s, d):
    return profile.by_split(fx.source_rows(s, d)).select("split", "identities")


@query("ag3_cameras", given("source_rows") + "SELECT split, count(DISTINCT camid) AS cameras, array_to_string(list_sort(list(DISTINCT camid)), ',') AS camera_list FROM source_rows GROUP BY split")
def ag3(s, d):
    return profile.by_split(fx.source_rows(s, d)).select("split", "cameras", "camera_list")


@query("ag4_junk", given("source_rows") + "SELECT split, count(*) FILTER (WHERE pid = -1) AS junk FROM source_rows GROUP BY split")
def ag4(s, d):
    return profile.by_split(fx.source_rows(s, d)).select("split", "junk")


@query("ag5_cameras_of_identities", given("leaky") + "SELECT split, pid, count(DISTINCT camid) AS cameras FROM leaky WHERE pid <> -1 GROUP BY split, pid")
def ag5(s, d):
    return profile.cameras_of_identities(fx.leaky(s, d))


@query("ag6_single_camera", given("leaky") + ", c AS (SELECT split, pid, count(DISTINCT camid) AS n FROM leaky WHERE pid <> -1 GROUP BY split, pid) SELECT split, count(*) AS identities, count(*) FILTER (WHERE n = 1) AS single, round(100.0 * count(*) FILTER (WHERE n = 1) / count(*), 4) AS percent FROM c GROUP BY split")
def ag6(s, d):
    return profile.single_camera(fx.leaky(s, d))


@query("ag7_crops_per_identity", given("leaky") + """, c AS (SELECT split, pid, count(*) AS n FROM leaky WHERE pid <> -1 GROUP BY split, pid)
    SELECT split, min(n) AS least, list_sort(list(n))[CAST(count(*) // 2 + 1 AS BIGINT)] AS median, max(n) AS most, count(*) FILTER (WHERE n < 2) AS below_2, count(*) FILTER (WHERE n < 4) AS below_4 FROM c GROUP BY split""")
def ag7(s, d):
    return profile.crops_per_identity(fx.leaky(s, d))


@query("ag8_image_sizes", given("boxes") + """SELECT dimension, min(v) AS least, list_sort(list(v))[CAST(count(*) // 2 + 1 AS BIGINT)] AS median, max(v) AS most
    FROM (SELECT 'h' AS dimension, h AS v FROM boxes UNION ALL SELECT 'w', w FROM boxes) GROUP BY dimension""")
def ag8(s, d):
    return profile.image_sizes(fx.boxes(s, d))


@query("ag18_detection_count", given("detections") + "SELECT count(*) AS detections FROM detections")
def ag18(s, d):
    from strataline.operators import encoders

    return encoders.count_of_detections(fx.detections(s, d).groupBy("image_id").agg(F.collect_list("dt_id").alias("boxes")))


@query("ag19_epoch_means", "SELECT epoch, round(avg(loss), 6) AS loss, round(avg(acc), 6) AS acc FROM (SELECT event_id % 7 AS epoch, CAST(event_id % 1000 AS DOUBLE) / 8 AS loss, CAST(event_id % 16 AS DOUBLE) / 16 AS acc FROM events) GROUP BY epoch")
def ag19(s, d):
    e = C("event_id")
    log = fx.table(s, d, "events").select((e % 7).alias("epoch"), ((e % 1000) / 8.0).alias("loss"), ((e % 16) / 16.0).alias("acc"))
    return profile.epoch_means(log).select("epoch", F.round("loss", 6).alias("loss"), F.round("acc", 6).alias("acc"))


@query("ag21_source_share", given("manifest") + f""", t AS (SELECT * FROM manifest WHERE split = '{TRAIN}' AND pid <> -1),
    p AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS part FROM (SELECT count(DISTINCT orig_pid) AS n FROM t WHERE starts_with(source, 'supp') GROUP BY source)), w AS (SELECT count(DISTINCT pid) AS whole FROM t)
    SELECT part, whole, round(100.0 * part / greatest(whole, 1), 4) AS percent, greatest(CAST(round_even(whole / greatest(part, 1), 0) AS BIGINT), 1) AS one_in, (SELECT count(*) FROM manifest WHERE split = '{TRAIN}') // 64 AS steps FROM p, w""")
def ag21(s, d):
    return profile.share_of_sources(manifest(s, d), "supp")


@query("ag22_source_table", given("source_rows") + f"""SELECT source, count(DISTINCT CASE WHEN split = '{TRAIN}' AND pid <> -1 THEN pid END) AS train_ids, count(*) FILTER (WHERE split = '{TRAIN}') AS train_crops,
    count(DISTINCT CASE WHEN split = '{QUERY}' AND pid <> -1 THEN pid END) AS eval_ids, count(*) FILTER (WHERE split = '{QUERY}') AS query_crops, count(*) FILTER (WHERE split = '{GALLERY}') AS gallery_crops FROM source_rows GROUP BY source""")
def ag22(s, d):
    return profile.source_table(fx.source_rows(s, d))


@query("ag23_epoch_length", given("crops") + f"SELECT CAST(coalesce(sum(greatest(n, 4) - greatest(n, 4) % 4), 0) AS BIGINT) AS length FROM (SELECT pid, count(*) AS n FROM crops WHERE split = '{TRAIN}' GROUP BY pid)")
def ag23(s, d):
    return sampling.epoch_length(fx.crops(s, d).filter(C("split") == TRAIN), 4)


@query("ag24_label_count", given("source_rows") + f"SELECT count(DISTINCT pid) AS identities FROM source_rows WHERE split = '{TRAIN}' AND pid <> -1")
def ag24(s, d):
    return profile.label_count(fx.source_rows(s, d))


# --- order, limits, samples ----------------------------------------------------------------------------------


@query("wn1_stride", given("boxes").replace("WITH ", "WITH RECURSIVE ") + f""", a AS (SELECT *, row_number() OVER (PARTITION BY sequence, camera, tid ORDER BY frame, position) AS rn FROM boxes WHERE {_ACCEPTED}),
    walk AS (SELECT sequence, camera, tid, rn, frame AS last, position, true AS kept FROM a WHERE rn = 1
    UNION ALL SELECT a.sequence, a.camera, a.tid, a.rn, CASE WHEN a.frame - w.last >= {fx.STRIDE} THEN a.frame ELSE w.last END, a.position, a.frame - w.last >= {fx.STRIDE}
    FROM walk w JOIN a ON a.sequence = w.sequence AND a.camera = w.camera AND a.tid = w.tid AND a.rn = w.rn + 1)
    SELECT position FROM walk WHERE kept""")
def wn1(s, d):
    return sampling.keep_stride(accepted(s, d), fx.STRIDE).select("position")


@query("wn5_contiguous_labels", given("leaky") + "SELECT pid, dense_rank() OVER (ORDER BY pid) - 1 AS label FROM (SELECT DISTINCT pid FROM leaky)")
def wn5(s, d):
    return listings.contiguous(fx.leaky(s, d), "pid")


@query("wn6_first_of_camera", given("crops") + "SELECT camid, vec_id FROM (SELECT camid, vec_id, row_number() OVER (PARTITION BY camid ORDER BY path) AS n FROM crops) WHERE n <= 24")
def wn6(s, d):
    return sinks.contact_rows(fx.crops(s, d)).select("camid", "vec_id")


_CHUNKS = f""", o AS (SELECT pid, vec_id, row_number() OVER (PARTITION BY pid ORDER BY md5('42:' || vec_id), vec_id) - 1 AS n, count(*) OVER (PARTITION BY pid) AS size FROM crops WHERE split = '{TRAIN}'),
    c AS (SELECT pid, vec_id, n // 4 AS chunk, n % 4 AS slot FROM o WHERE size >= 4 AND n < size - size % 4 UNION ALL SELECT pid, vec_id, 0, k FROM o, range(4) t(k) WHERE size < 4 AND k % size = n)"""


@query("wn7_chunks", given("crops") + _CHUNKS + " SELECT pid, vec_id, chunk, slot FROM c")
def wn7(s, d):
    return sampling.chunks(fx.crops(s, d).filter(C("split") == TRAIN), 4).select("pid", "vec_id", "chunk", "slot")


@query("st1_box_order", given("boxes") + "SELECT frame, tid, position FROM boxes ORDER BY frame, tid, position")
def st1(s, d):
    return fx.boxes(s, d).select("frame", "tid", "position").orderBy("frame", "tid", "position")


@query("st2_listing_order", given("listing") + "SELECT name, position FROM listing ORDER BY name, position")
def st2(s, d):
    return fx.listing(s, d).select("name", "position").orderBy("name", "position")


@query("st4_check_flag", given("boxes") + "SELECT position, vis >= 0.93 AS check_it FROM boxes")
def st4(s, d):
    return fx.boxes(s, d).select("position", (C("vis") >= 0.93).alias("check_it"))


@query("st5_examples", given("leaky") + f"SELECT split, array_to_string(list_sort(list(DISTINCT pid))[1:8], ',') AS examples FROM leaky GROUP BY split")
def st5(s, d):
    some = F.slice(F.sort_array(F.collect_set("pid")), 1, 8)
    return fx.leaky(s, d).groupBy("split").agg(F.array_join(F.transform(some, lambda x: x.cast("string")), ",").alias("examples"))


@query("st6_seeded_sample", given("boxes") + "SELECT position FROM boxes ORDER BY md5('42:' || position), position LIMIT 600")
def st6(s, d):
    return sampling.seeded_sample(fx.boxes(s, d), "position").select("position")


@query("st8_fraction", given("crops") + f"SELECT vec_id FROM crops WHERE split = '{TRAIN}' AND CAST('0x' || md5('42:' || vec_id)[1:8] AS BIGINT) < {2**32 // 4}")
def st8(s, d):
    return sampling.fraction(fx.crops(s, d).filter(C("split") == TRAIN), "vec_id", 0.25).select("vec_id")


# The most batches that there can be, chunks dealt to them one after the other in the seed's order of identities.
@query("st7_identity_batches", given("crops") + _CHUNKS + """, i AS (SELECT pid, count(DISTINCT chunk) AS n, md5('42:' || pid) AS o FROM c GROUP BY pid),
    b AS (SELECT max(x.b) AS b FROM (SELECT unnest(range(1, (SELECT CAST(sum(n) // 4 AS BIGINT) + 1 FROM i))) AS b) x WHERE (SELECT sum(least(n, x.b)) FROM i) >= 4 * x.b),
    a AS (SELECT b, max(x.a) AS a FROM b, (SELECT unnest(range(1, (SELECT greatest(1, b * 618 // 1000) + 1 FROM b))) AS a) x WHERE gcd(x.a, b) = 1 GROUP BY b),
    p AS (SELECT pid, least(n, b) AS n, coalesce(sum(least(n, b)) OVER (ORDER BY o, pid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM i, b),
    t AS (SELECT pid, CAST(f AS BIGINT) + unnest(range(n)) AS t FROM p), d AS (SELECT pid, (t * a + 42) % b AS batch, t // b AS place FROM t, a WHERE t < 4 * b),
    r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY batch) - 1 AS chunk FROM d)
    SELECT batch, place, pid, chunk, slot, vec_id FROM r JOIN c USING (pid, chunk)""")
def st7(s, d):
    return sampling.batches(fx.crops(s, d).filter(C("split") == TRAIN), 16, 4).select("batch", "place", "pid", "chunk", "slot", "vec_id")


# The draw is by chance, but not what any draw has: per identity the chunks that were drawn at most once, whole
# batches of different identities, chunks in turn, and fewer identities left than a batch needs.
@query("st7_batch_invariants", given("crops") + _CHUNKS + """, left_over AS (SELECT pid, count(DISTINCT chunk) AS chunks FROM c GROUP BY pid)
    SELECT count(*) AS identities, CAST(sum(chunks) AS BIGINT) AS chunks, 0 AS uneven_batches, 0 AS uneven_chunks, 0 AS repeated, 0 AS out_of_turn, true AS exhausted FROM left_over""")
def st7_invariants(s, d):
    train = fx.crops(s, d).filter(C("split") == TRAIN)
    cut = sampling.chunks(train, 4).groupBy("pid").agg(F.count_distinct("chunk").alias("chunks"))
    drawn = sampling.batches(train, 16, 4)
    per_batch = drawn.groupBy("batch").agg(F.count("*").alias("n"), F.count_distinct("pid").alias("pids"), F.count_distinct("place").alias("places"))
    per_chunk = drawn.groupBy("pid", "chunk").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("slots"), F.count_distinct("batch").alias("batches"))
    turns = drawn.groupBy("pid", "chunk").agg(F.max("batch").alias("batch")).groupBy("pid").agg(F.max("chunk").alias("last"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("chunk", "batch"))).alias("t"))
    in_turn = F.col("t.batch") == F.array_sort(F.col("t.batch"))
    rest = cut.join(turns.select("pid", "n"), "pid", "left").agg(F.count("*").alias("identities"), F.sum("chunks").cast("bigint").alias("chunks"), F.count_if(C("chunks") > F.coalesce("n", F.lit(0))).alias("open"))
    return (
        rest.join(per_batch.agg(F.count_if(F.expr("n <> 16 OR pids <> 4 OR places <> 4")).cast("int").alias("uneven_batches")))
        .join(per_chunk.agg(F.count_if(F.expr("n <> 4 OR slots <> 4")).cast("int").alias("uneven_chunks"), F.count_if(F.expr("batches <> 1")).cast("int").alias("repeated")))
        .join(turns.agg(F.count_if((C("n") != C("last") + 1) | ~in_turn).cast("int").alias("out_of_turn")))
        .select("identities", "chunks", "uneven_batches", "uneven_chunks", "repeated", "out_of_turn", (C("open") < 4).alias("exhausted"))
    )


# --- sets ----------------------------------------------------------------------------------------------------


@query("se1_union", given("source_rows") + "SELECT source, split, pid FROM source_rows WHERE source = 'customer' UNION ALL SELECT source, split, pid FROM source_rows WHERE source = 'supplier'")
def se1(s, d):
    rows = fx.source_rows(s, d).select("source", "split", "pid")
    return rows.filter("source = 'customer'").unionByName(rows.filter("source = 'supplier'"))


def _ids(s, d, split):
    return fx.leaky(s, d).filter(C("split") == split).select("pid")


@query("se2_intersect", given("leaky") + f"SELECT pid FROM leaky WHERE split = '{QUERY}' INTERSECT SELECT pid FROM leaky WHERE split = '{GALLERY}'")
def se2(s, d):
    return _ids(s, d, QUERY).intersect(_ids(s, d, GALLERY))


@query("se3_except", given("leaky") + f"SELECT pid FROM leaky WHERE split = '{QUERY}' EXCEPT SELECT pid FROM leaky WHERE split = '{GALLERY}'")
def se3(s, d):
    return _ids(s, d, QUERY).subtract(_ids(s, d, GALLERY))


@query("se4_union_distinct", given("leaky") + f"SELECT pid FROM leaky WHERE split = '{QUERY}' UNION SELECT pid FROM leaky WHERE split = '{GALLERY}'")
def se4(s, d):
    return _ids(s, d, QUERY).union(_ids(s, d, GALLERY)).distinct()


@query("se5_camera_difference", given("leaky") + f"""SELECT pid, array_to_string(list_sort(list_filter(g, lambda c: NOT list_contains(q, c))), ',') AS cameras FROM
    (SELECT pid, coalesce(list(DISTINCT camid) FILTER (WHERE split = '{GALLERY}'), []) AS g, coalesce(list(DISTINCT camid) FILTER (WHERE split = '{QUERY}'), []) AS q FROM leaky GROUP BY pid)""")
def se5(s, d):
    sets = fx.leaky(s, d).groupBy("pid").agg(F.collect_set(F.when(C("split") == GALLERY, C("camid"))).alias("g"), F.collect_set(F.when(C("split") == QUERY, C("camid"))).alias("q"))
    return sets.select("pid", F.array_join(F.transform(F.sort_array(F.array_except("g", "q")), lambda c: c.cast("string")), ",").alias("cameras"))


@query("se6_distinct", given("leaky") + "SELECT DISTINCT split, pid FROM leaky")
def se6(s, d):
    return fx.leaky(s, d).select("split", "pid").distinct()


# --- integrity -----------------------------------------------------------------------------------------------

_LEAK = f"SELECT pid FROM rows WHERE split = '{TRAIN}' INTERSECT SELECT pid FROM rows WHERE split <> '{TRAIN}'"


def _with_junk(s, d):
    """The failing projection with junk in train and gallery."""
    more = fx.leaky(s, d).filter("vec_id < 2").withColumn("pid", F.lit(JUNK).cast("bigint")).withColumn("split", F.when(C("vec_id") == 0, TRAIN).otherwise(GALLERY))
    return fx.leaky(s, d).unionByName(more)


_JUNKY = given("leaky") + f", rows AS (SELECT pid, camid, split FROM leaky UNION ALL SELECT -1, camid, CASE WHEN vec_id = 0 THEN '{TRAIN}' ELSE '{GALLERY}' END FROM leaky WHERE vec_id < 2) "


@query("ic1_leaking_identities", _JUNKY.replace("rows AS (", "junky AS (").rstrip() + f", rows AS (SELECT * FROM junky WHERE pid <> -1) {_LEAK}")
def ic1(s, d):
    return constraints.leaking(_with_junk(s, d))


@query("ic1b_leaking_with_junk", _JUNKY + _LEAK)
def ic1b(s, d):
    return constraints.leaking(_with_junk(s, d), exclude_junk=False)


@query("ic2_missing_from_gallery", given("leaky") + f"SELECT pid FROM leaky WHERE split = '{QUERY}' AND pid <> -1 EXCEPT SELECT pid FROM leaky WHERE split = '{GALLERY}'")
def ic2(s, d):
    return constraints.missing_from_gallery(fx.leaky(s, d))


@query("ic3_unanswerable_crops", given("leaky") + f"SELECT vec_id, pid, camid FROM leaky q WHERE split = '{QUERY}' AND NOT EXISTS (SELECT 1 FROM leaky g WHERE g.split = '{GALLERY}' AND g.pid = q.pid AND g.camid <> q.camid)")
def ic3(s, d):
    return constraints.unanswerable_crops(fx.leaky(s, d)).select("vec_id", "pid", "camid")


@query("ic4_unanswerable_identities", given("leaky") + f"""SELECT DISTINCT pid FROM leaky q WHERE split = '{QUERY}' AND NOT EXISTS (SELECT 1 FROM leaky g WHERE g.split = '{GALLERY}' AND g.pid = q.pid
    AND NOT EXISTS (SELECT 1 FROM leaky o WHERE o.split = '{QUERY}' AND o.pid = g.pid AND o.camid = g.camid))""")
def ic4(s, d):
    return constraints.unanswerable_identities(fx.leaky(s, d))


@query("ic5_unknown_splits", given("leaky") + "SELECT DISTINCT 'val' AS split FROM leaky WHERE vec_id % 5 = 0")
def ic5(s, d):
    return constraints.unknown_splits(fx.leaky(s, d).withColumn("split", F.when(C("vec_id") % 5 == 0, "val").otherwise(C("split"))))


@query("ic6_clashing_sources", """WITH f AS (SELECT unnest([{'field': 'tag', 'value': s_name[-3:]}, {'field': 'pid_offset', 'value': CAST(1000 * s_nationkey AS VARCHAR)}, {'field': 'cam_offset', 'value': CAST(10 * s_suppkey AS VARCHAR)}]) AS x FROM supplier)
    SELECT x.field AS field, x.value AS value, count(*) AS n FROM f GROUP BY ALL HAVING count(*) > 1""")
def ic6(s, d):
    sources = fx.table(s, d, "supplier").select(C("s_name").alias("name"), F.substring("s_name", -3, 3).alias("tag"), (1000 * C("s_nationkey")).cast("bigint").alias("pid_offset"), (10 * C("s_suppkey")).alias("cam_offset"), F.lit(True).alias("use_eval"))
    return constraints.clashing_sources(sources)


# One recipe for each customer, of which several lack something.
@query("ic7_recipe_problems", """WITH r AS (SELECT c_custkey AS k, c_custkey % 7 = 0 AS unnamed, c_custkey % 11 = 0 AS absent, c_custkey % 13 = 0 AS none FROM customer),
    s AS (SELECT k, i AS place FROM (SELECT *, unnest(range(2)) AS i FROM r WHERE NOT absent AND NOT none))
    SELECT k, CAST(NULL AS INTEGER) AS place, 'recipe lacks name' AS problem FROM r WHERE unnamed UNION ALL SELECT k, NULL, 'recipe lacks sources' FROM r WHERE absent
    UNION ALL SELECT k, NULL, 'recipe has no sources' FROM r WHERE none AND NOT absent
    UNION ALL SELECT k, CAST(place AS INTEGER), 'source lacks tag' FROM s WHERE (k + place) % 5 = 0 UNION ALL SELECT k, CAST(place AS INTEGER), 'source lacks cam_offset' FROM s WHERE (k + place) % 3 = 0""")
def ic7(s, d):
    k = C("c_custkey")

    def source(i):
        return F.struct(C("c_name").alias("name"), F.when((k + i) % 5 != 0, F.lit(f"t{i}")).alias("tag"), F.lit(1000 * i).alias("pid_offset"), F.when((k + i) % 3 != 0, F.lit(10 * i)).alias("cam_offset"))

    sources = F.when(k % 11 == 0, None).when(k % 13 == 0, F.slice(F.array(source(0), source(1)), 1, 0)).otherwise(F.array(source(0), source(1)))
    text = F.to_json(F.struct(F.when(k % 7 != 0, C("c_name")).alias("name"), sources.alias("sources")))
    return tables.recipe_problems(fx.table(s, d, "customer").select(k.alias("k"), text.alias("value")))


@query("ic8_repeated_names", given("listing") + ", n AS (SELECT 'query' AS split, regexp_replace(name, '_f.*$', '') || '.jpg' AS name FROM listing) SELECT split, name, count(*) AS n FROM n GROUP BY split, name HAVING count(*) > 1")
def ic8(s, d):
    return constraints.repeated_names(fx.listing(s, d).select(F.lit(QUERY).alias("split"), F.concat(F.regexp_replace("name", "_f.*$", ""), F.lit(".jpg")).alias("name")))


# Builds of seven identities, and some of suppliers that have no files.
@query("ic9_missing_splits", given("source_rows") + f""", files AS (SELECT DISTINCT CAST(pid // 7 AS VARCHAR) AS build, split FROM source_rows WHERE source = 'customer' AND pid <> -1),
    builds AS (SELECT CAST(c_custkey // 7 AS VARCHAR) AS build FROM customer UNION SELECT 'supplier-' || s_nationkey FROM supplier)
    SELECT build, split FROM builds, (VALUES ('{TRAIN}'), ('{QUERY}'), ('{GALLERY}')) x(split) EXCEPT SELECT build, split FROM files""")
def ic9(s, d):
    rows = fx.source_rows(s, d).filter(f"source = 'customer' AND pid <> {JUNK}")
    paths = rows.select(F.concat_ws("/", F.floor(C("pid") / 7).cast("string"), "split", "file").alias("path"))
    builds = fx.table(s, d, "customer").select(F.floor(C("c_custkey") / 7).cast("string").alias("build"))
    return listings.missing_splits(paths, builds.union(fx.table(s, d, "supplier").select(F.concat(F.lit("supplier-"), C("s_nationkey").cast("string")))))


@query("ic10_empty_train", given("leaky") + f"SELECT count(*) AS n FROM leaky WHERE split = '{TRAIN}' AND pid < 0 HAVING count(*) = 0")
def ic10(s, d):
    return constraints.empty_train(fx.leaky(s, d).filter("pid < 0"))


@query("ic11_unparsable_names", given("listing") + f"SELECT name FROM listing WHERE NOT {_OK}")
def ic11(s, d):
    return constraints.unparsable(fx.listing(s, d))


@query("ic12_batch_problems", given("leaky") + """, n AS (SELECT count(DISTINCT pid) AS identities FROM leaky), p AS (SELECT DISTINCT o_orderkey % 997 AS batch_size, o_orderkey % 5 AS k FROM orders),
    t AS (SELECT batch_size, k, identities, CASE WHEN batch_size < 1 OR k < 1 THEN 'sizes are not positive' WHEN batch_size % k <> 0 THEN 'the batch size is not a multiple of k'
    WHEN batch_size // k > identities THEN 'there are fewer identities than a batch needs' END AS problem FROM p, n) SELECT * FROM t WHERE problem IS NOT NULL""")
def ic12(s, d):
    plans = fx.table(s, d, "orders").select((C("o_orderkey") % 997).alias("batch_size"), (C("o_orderkey") % 5).alias("k")).distinct()
    return sampling.batch_problems(fx.leaky(s, d), plans)


@query("ic13_lone_anchors", given("leaky") + ", c AS (SELECT vec_id // 6 AS batch, pid AS label, count(*) AS n FROM leaky WHERE vec_id % 9 <> 0 GROUP BY ALL) SELECT batch, count(*) AS labels, count(*) FILTER (WHERE n = 1) AS singles FROM c GROUP BY batch HAVING count(*) < 2 OR count(*) FILTER (WHERE n = 1) > 0")
def ic13(s, d):
    return constraints.lone_anchors(fx.leaky(s, d).filter("vec_id % 9 <> 0").select(F.floor(C("vec_id") / 6).cast("bigint").alias("batch"), C("pid").alias("label")))


# Sessions of two identities each.
@query("ic14_unevaluable", given("leaky") + f"""SELECT vec_id // 8 AS session, count(*) AS queries FROM leaky q WHERE split = '{QUERY}' GROUP BY ALL
    HAVING count(*) FILTER (WHERE EXISTS (SELECT 1 FROM leaky g WHERE g.split = '{GALLERY}' AND g.pid = q.pid AND g.camid <> q.camid)) = 0""")
def ic14(s, d):
    return constraints.unevaluable(fx.leaky(s, d).withColumn("session", F.floor(C("vec_id") / 8).cast("bigint")), ("session",))


@query("ic15_unknown_actions", given("decisions") + "SELECT pid, 'kepe' AS action FROM decisions WHERE pid % 50 = 0")
def ic15(s, d):
    return constraints.unknown_actions(fx.decisions(s, d).withColumn("action", F.when(C("pid") % 50 == 0, "kepe").otherwise(C("action"))))


@query("ic16_uneven_detections", given("detections") + ", i AS (SELECT image_id, count(*) AS n FROM detections GROUP BY image_id) SELECT image_id FROM i WHERE image_id % 4 = 0 AND n <> 1")
def ic16(s, d):
    rows = fx.detections(s, d).groupBy("image_id").agg(F.collect_list("dt_id").alias("boxes"))
    return constraints.uneven_detections(rows.withColumn("scores", F.when(C("image_id") % 4 == 0, F.slice("boxes", 1, 1)).otherwise(C("boxes"))).withColumn("classes", C("boxes")))


# A build that is written as it is, read back and verified.
@query("ic17_build_report", given("leaky") + f""", rows AS (SELECT * FROM leaky WHERE pid <> -1) SELECT 'leaking' AS rule, pid, CAST(NULL AS BIGINT) AS camid, CAST(NULL AS BIGINT) AS n FROM ({_LEAK})
    UNION ALL SELECT 'missing from gallery', pid, NULL, NULL FROM (SELECT pid FROM rows WHERE split = '{QUERY}' EXCEPT SELECT pid FROM rows WHERE split = '{GALLERY}')
    UNION ALL SELECT 'without a second camera', pid, camid, count(*) FROM leaky q WHERE split = '{QUERY}' AND NOT EXISTS (SELECT 1 FROM leaky g WHERE g.split = '{GALLERY}' AND g.pid = q.pid AND g.camid <> q.camid) GROUP BY pid, camid""")
def ic17(s, d):
    path = f"{shared_dir(s)}/build-{uuid.uuid4().hex}"
    fx.leaky(s, d).write.partitionBy("split").parquet(path)
    return constraints.build_report(s.read.parquet(path))


@query("audit_overlapping_ranges", given("source_rows") + ", r AS (SELECT source, min(pid) AS low, max(pid) AS high FROM source_rows WHERE pid <> -1 GROUP BY source) SELECT a.source AS source_a, b.source AS source_b FROM (SELECT source, low + CASE WHEN source = 'supplier' THEN 10 ELSE 0 END AS low, high + CASE WHEN source = 'supplier' THEN 10 ELSE 0 END AS high FROM r) a, (SELECT source, low + CASE WHEN source = 'supplier' THEN 10 ELSE 0 END AS low, high + CASE WHEN source = 'supplier' THEN 10 ELSE 0 END AS high FROM r) b WHERE a.source < b.source AND a.low <= b.high AND b.low <= a.high")
def audit_ranges(s, d):
    sources = s.createDataFrame([("customer", 0), ("supplier", 10)], "name string, pid_offset bigint")
    return constraints.overlapping_ranges(fx.source_rows(s, d), sources)
