"""Small tables that people or earlier stages write: decisions, scores, recipes, detection ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def last_wins(rows: DataFrame, key: str, value: str, position: Column | str) -> DataFrame:
    """The last row of each key by position."""
    place = F.col(position) if isinstance(position, str) else position
    return rows.withColumn("__place", place).groupBy(key).agg(F.max_by(value, "__place").alias(value))


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """pid and action; a missing file decides nothing, and the last row of a pid holds."""
    if not exists(spark, path):
        return spark.createDataFrame([], "pid bigint, action string")
    rows = spark.read.option("header", True).schema("pid bigint, action string").csv(path)
    return last_wins(rows.withColumn("action", F.trim("action")), "pid", "action", F.monotonically_increasing_id())


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """file and self_sim; a missing file raises, and the last row of a file holds."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    rows = spark.read.option("header", True).schema("file string, self_sim double").csv(path)
    return last_wins(rows, "file", "self_sim", F.monotonically_increasing_id())


RECIPE_FIELDS = "name string, tag string, pid_offset bigint, cam_offset bigint, use_eval boolean"


def recipe(spark: SparkSession, spec: dict) -> tuple[str, DataFrame]:
    """Name and sources of a recipe {name, sources: [{name, tag, pid_offset, cam_offset, use_eval}]}."""
    missing = [k for k in ("name", "sources") if k not in spec]
    if missing:
        raise ValueError(f"recipe lacks {', '.join(missing)}")
    if not spec["sources"]:
        raise ValueError("recipe has no sources")
    rows = []
    for s in spec["sources"]:
        lacking = [k for k in ("name", "tag", "pid_offset", "cam_offset") if k not in s]
        if lacking:
            raise ValueError(f"source lacks {', '.join(lacking)}")
        rows.append((str(s["name"]), str(s["tag"]), int(s["pid_offset"]), int(s["cam_offset"]), bool(s.get("use_eval", True))))
    for k, what in ((1, "tags"), (2, "identity offsets"), (3, "camera offsets")):
        if len({r[k] for r in rows}) != len(rows):
            raise ValueError(f"{what} are not distinct")
    return spec["name"], spark.createDataFrame(rows, RECIPE_FIELDS)


def recipe_sources(text: DataFrame, col: str = "value") -> DataFrame:
    """Sources of many recipes held as JSON, a row for each: recipe, name, tag, pid_offset, cam_offset, use_eval (true
    where nothing is said). A text that is no recipe gives no row; constraints.clashing_sources() tells clashes."""
    kind = f"name string, sources array<struct<{', '.join(f.replace(' ', ':') for f in RECIPE_FIELDS.split(', '))}>>"
    rows = text.select(F.from_json(col, kind).alias("r")).select(F.col("r.name").alias("recipe"), F.explode("r.sources").alias("s"))
    return rows.select("recipe", "s.name", "s.tag", "s.pid_offset", "s.cam_offset", F.coalesce("s.use_eval", F.lit(True)).alias("use_eval"))


def recipe_problems(text: DataFrame, col: str = "value") -> DataFrame:
    """Why recipes held as JSON cannot be used: the other columns, place (of the source, null for the recipe) and problem.

    A text that is no recipe, null included, lacks name and sources; repeated texts are told each for itself.
    """
    kind = f"name string, sources array<struct<{', '.join(f.replace(' ', ':') for f in RECIPE_FIELDS.split(', '))}>>"
    r, nowhere = F.from_json(col, kind), F.lit(None).cast("int")

    def told(wrong: Column, problem: str, place: Column = nowhere) -> Column:
        return F.when(wrong, F.struct(place.alias("place"), F.lit(problem).alias("problem")))

    of_recipe = F.array(
        told(F.col("__r.name").isNull(), "recipe lacks name"),
        told(F.col("__r.sources").isNull(), "recipe lacks sources"),
        told(F.size("__r.sources") == 0, "recipe has no sources"),
    )

    def lacking(field: str) -> Column:
        return F.transform("__r.sources", lambda s, k: told(s.isNull() | s[field].isNull(), f"source lacks {field}", k))

    of_sources = F.coalesce(F.concat(*[lacking(f) for f in ("name", "tag", "pid_offset", "cam_offset")]), F.array())
    kept = [c for c in text.columns if c != col]
    rows = text.select(*kept, r.alias("__r")).select(*kept, F.explode(F.concat(of_recipe, of_sources)).alias("__p"))
    return rows.filter("__p IS NOT NULL").select(*kept, "__p.place", "__p.problem")


def read_recipe(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    import yaml

    text = "\n".join(r.value for r in spark.read.text(path).collect())  # a page of settings
    return recipe(spark, yaml.safe_load(text) or {})


COCO = "images array<struct<id:bigint,file_name:string>>, categories array<struct<id:bigint>>, annotations array<struct<id:bigint,image_id:bigint,category_id:bigint,bbox:array<double>,area:double,iscrowd:int>>"


def coco_images(text: DataFrame, col: str = "value") -> DataFrame:
    """image_id and file_name of ground-truth documents held as JSON."""
    return text.select(F.explode(F.from_json(col, COCO)["images"]).alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name")


def coco_annotations(text: DataFrame, col: str = "value") -> DataFrame:
    rows = text.select(F.explode(F.from_json(col, COCO)["annotations"]).alias("a"))
    return rows.select(F.col("a.id").alias("gt_id"), "a.image_id", "a.category_id", *[F.element_at("a.bbox", k + 1).alias(n) for k, n in enumerate("xywh")], F.coalesce("a.iscrowd", F.lit(0)).alias("iscrowd"))


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)
