"""Dataset building: splits without leakage, validation of annotations, label lines, window classification."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundhouse.operators.aggregates import META_LABELS, latest_annotation
from roundhouse.operators.joins import point_in_interval_join, top1_similarity
from roundhouse.operators.picks import with_place
from roundhouse.operators.scalar import with_rotated


def split_sorted(df: DataFrame, key: str, ratio: float = 0.8) -> DataFrame:
    """Distinct names in order: the first floor(n * ratio) are train, the rest test. For tables of names."""
    names = df.select(key).distinct()
    n = F.count("*").over(Window.partitionBy(F.lit(0)))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key))
    return names.withColumn("split", F.when(place <= F.floor(n * ratio), "train").otherwise("test"))


def split_hashed(df: DataFrame, group: str, ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """df with a split by group, in random order; at least one group is test."""
    groups = with_place(df.select(group).distinct(), [], [group], seed)
    groups = groups.withColumn("split", F.when(F.col("__place") <= F.least(F.floor(F.col("__size") * ratio), F.col("__size") - 1), "train").otherwise("test")).drop("__place", "__size")
    return df.join(groups, group)


def split_stratified(df: DataFrame, stratum: str, ids: list[str], fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Per stratum max(1, round(n * fraction)) rows are val, halves to even."""
    rows = with_place(df, [stratum], ids, seed)
    return rows.withColumn("split", F.when(F.col("__place") <= F.greatest(F.lit(1), F.bround(F.col("__size") * fraction)), "val").otherwise("train")).drop("__place", "__size")


def kfold_stratified(df: DataFrame, stratum: str, ids: list[str], k: int = 5, seed: int = 42) -> DataFrame:
    """A fold for each row, dealt round robin in random order within its stratum."""
    return with_place(df, [stratum], ids, seed).withColumn("fold", ((F.col("__place") - 1) % k).cast("int")).drop("__place", "__size")


def oversample(df: DataFrame, flag: Column, multiplier: int = 5, name: str = "name") -> DataFrame:
    """Flagged rows `multiplier` times, the copies with _r1, _r2 and so on at their names."""
    rows = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(flag, F.lit(multiplier - 1)).otherwise(F.lit(0)))))
    return rows.withColumn(name, F.when(F.col("copy") > 0, F.concat(F.col(name), F.lit("_r"), F.col("copy"))).otherwise(F.col(name)))


def validate_annotations(segs: DataFrame, need_meta: tuple[str, ...] = META_LABELS, two_keyframes: tuple[str, ...] = ("split", "hit"), one_box: tuple[str, ...] = ("tap", "call for action")) -> DataFrame:
    """One message per segment and broken rule, and an OK row per video without any.

    segs: round_id, seg_id, label, meta_text, n_boxes, n_keyframes (of the first box).
    """
    label = F.col("label")
    rules = [
        ("meta_missing", label.isin(*need_meta) & (F.coalesce("meta_text", F.lit("")) == "")),
        ("needs_one_box_two_keyframes", label.isin(*two_keyframes) & ~((F.col("n_boxes") == 1) & (F.coalesce("n_keyframes", F.lit(0)) == 2))),
        ("needs_one_box", label.isin(*one_box) & (F.col("n_boxes") != 1)),
    ]
    broken = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())
    own = Window.partitionBy("round_id").orderBy("seg_id")
    rows = segs.select("round_id", "seg_id", "label", broken.alias("__rules"))  # read once: the rows may come from parsed exports
    rows = rows.withColumns({"__place": F.row_number().over(own), "__n": F.sum(F.size("__rules")).over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    fine = (F.col("__n") == 0) & (F.col("__place") == 1)
    rows = rows.withColumn("rule", F.explode(F.when(fine, F.array(F.lit("OK"))).otherwise(F.col("__rules"))))
    own_row = F.col("rule") != "OK"
    return rows.select("round_id", F.when(own_row, F.col("seg_id")).alias("seg_id"), F.when(own_row, F.col("label")).alias("label"), "rule")


EXPORT = "array<struct<type:string,id:bigint,start:int,end:int,label:string,frame:int,x1:int,y1:int,x2:int,y2:int>>"


def extract_export(tasks: DataFrame) -> DataFrame:
    """Segments of each task in order of start, with the boxes whose frame they cover. tasks: round_id, result (EXPORT)."""
    item = tasks.select("round_id", F.explode("result").alias("r")).select("round_id", "r.*")
    segs = item.where("type = 'range'").select("round_id", F.col("id").alias("seg_id"), F.col("start").alias("start_frame"), F.col("end").alias("end_frame"), "label")
    boxes = item.where("type = 'rectangle'").select("round_id", F.col("id").alias("box_id"), F.col("frame").alias("anchor_frame"))
    hit = point_in_interval_join(boxes, segs, ["round_id"], "anchor_frame")
    own = hit.groupBy("round_id", "seg_id").agg(F.array_sort(F.collect_list("box_id")).alias("boxes"))
    order = Window.partitionBy("round_id").orderBy("start_frame", "seg_id")
    out = segs.join(own, ["round_id", "seg_id"], "left").withColumns({"place": F.row_number().over(order), "n_boxes": F.coalesce(F.size("boxes"), F.lit(0)), "span_exclusive": F.col("end_frame") - F.col("start_frame")})
    return out.withColumn("n_boxes", F.greatest("n_boxes", F.lit(0)))


def human_boxes(tasks: DataFrame, boxes: DataFrame) -> DataFrame:
    """Rotated boxes of each task's latest annotation, with a status. boxes: task_id, ann_seq, box_no, x, y, w, h, degrees."""
    best = latest_annotation(tasks).select("task_id", "ann_seq")
    rows = with_rotated(boxes.join(best, ["task_id", "ann_seq"]))
    out = tasks.select("task_id").distinct().join(best, "task_id", "left").join(rows.drop("ann_seq"), "task_id", "left")
    status = F.when(F.col("ann_seq").isNull(), "no_annotation").when(F.col("box_no").isNull(), "no_boxes").otherwise("ok")
    return out.withColumn("status", status)


def six_digits(value: Column) -> Column:
    """A number as text with six significant digits and no trailing zeros, in powers of ten below 0.0001 and from a million on."""
    parts = F.split(F.format_string("%.5e", value.cast("double")), "e")
    sign, digits, power = F.when(parts[0].startswith("-"), "-").otherwise(""), F.regexp_replace(parts[0], "[-.]", ""), parts[1].cast("int")
    trimmed = lambda text: F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    whole = F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.lit(6)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    plain = F.when(power >= 0, whole).otherwise(small)
    return F.when(power.between(-4, 5), F.concat(sign, trimmed(plain))).otherwise(F.concat(trimmed(parts[0]), F.lit("e"), parts[1]))


def obb_label_lines(boxes: DataFrame, w: float, h: float) -> DataFrame:
    """boxes (class_id, c0x to c3y in pixels) with a pixel line and a normalised line."""
    corner = [f"c{k}{a}" for k in range(4) for a in "xy"]
    dota = F.concat_ws(" ", *[F.format_string("%.1f", F.col(c)) for c in corner], F.concat(F.lit("class_"), F.col("class_id")), F.lit("0"))
    unit = F.concat_ws(" ", F.col("class_id").cast("string"), *[six_digits(F.col(c) / (w if c.endswith("x") else h)) for c in corner])
    return boxes.withColumns({"dota_line": dota, "obb_line": unit})


def apply_split_field(df: DataFrame, fallback: Column, field: str = "split") -> DataFrame:
    """The rows' own split if any row has one (rows without are train), else the fallback."""
    any_set = df.agg(F.coalesce(F.bool_or(F.col(field).isNotNull()), F.lit(False)).alias("__any"))
    return df.join(F.broadcast(any_set)).withColumn(field, F.when(F.col("__any"), F.coalesce(F.col(field), F.lit("train"))).otherwise(fallback)).drop("__any")


def mine_hard_negatives(items: DataFrame, focus: int, margin: float = 0.2, seed: int = 42, shift: int = 1) -> DataFrame:
    """Per focus item its most similar other item, and the margin loss against another focus item. items: id, label_id, vec.

    The positive is the item `shift` places on in a random ring of all focus items; a single focus item has none.
    """
    focused = items.where(F.col("label_id") == focus)
    q = focused.select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    other = items.where(F.col("label_id") != focus).select(F.col("id").alias("g_id"), F.col("vec").alias("g_vec"))
    neg = top1_similarity(q, other).withColumnsRenamed({"best": "neg", "g_id": "neg_id"})
    ring = with_place(focused.select("id", "vec"), [], ["id"], seed)
    own = ring.select("id", "vec", ((F.col("__place") - 1 + shift) % F.col("__size") + 1).alias("__at"))
    pos = own.join(ring.select(F.col("id").alias("pos_id"), F.col("vec").alias("next"), F.col("__place").alias("__at")), "__at").where("pos_id <> id")
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    dot = F.aggregate(F.zip_with("vec", "next", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    pos = pos.select(F.col("id").alias("q_id"), "pos_id", (F.floor(dot / (norm(F.col("vec")) * norm(F.col("next"))) * 10000 + 0.5) / 10000.0).alias("pos"))
    return neg.join(pos, "q_id", "left").withColumn("loss", F.when(F.col("pos").isNotNull(), F.floor(F.greatest(F.lit(0.0), margin - F.col("pos") + F.col("neg")) * 10000 + 0.5) / 10000.0))


def negative_pools(items: DataFrame, focus: int, hard: list[int], size: int = 8, seed: int = 42) -> DataFrame:
    """Per focus item (q_id) its sampled negatives: n_hard, the number of hard ones (labels `hard`), which every pool has, and the ids of soft ones up to `size` in all, one at least.

    Soft items are dealt in random order, so a pool repeats none and all are used evenly. The hard ones are the same for all: they aren't repeated here.
    """
    label = F.col("label_id")
    counts = items.agg(F.count_if(label.isin(hard) & (label != focus)).alias("n_hard"), F.count_if(~label.isin(hard) & (label != focus)).alias("n_soft"))  # one row
    counts = counts.withColumn("k", F.least("n_soft", F.greatest(F.lit(1), size - F.col("n_hard"))))
    anchors = with_place(items.where(label == focus).select(F.col("id").alias("q_id")), [], ["q_id"], seed).join(F.broadcast(counts))
    soft = with_place(items.where((label != focus) & ~label.isin(hard)).select(F.col("id").alias("neg_id")), [], ["neg_id"], seed).select("neg_id", F.col("__place").alias("__at"))
    wanted = F.when(F.col("k") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda j: ((F.col("__place") - 1) * F.col("k") + j) % F.col("n_soft") + 1))
    rows = anchors.select("q_id", "n_hard", F.explode_outer(wanted).alias("__at")).join(soft, "__at", "left")
    return rows.groupBy("q_id", "n_hard").agg(F.sort_array(F.collect_list("neg_id")).alias("soft"))


def with_label(videos: DataFrame, segs: DataFrame, label: str) -> DataFrame:
    return videos.join(segs.where(F.col("label") == label).select("round_id").distinct(), "round_id", "left_semi")


def fit_window_classifier(windows: DataFrame, layers: tuple[int, ...] | None = None, seed: int = 42):
    """A multi-class model of window vectors (vec, label_id): logistic regression, or a perceptron with the given hidden layers."""
    rows = windows.select(array_to_vector("vec").alias("raw"), F.col("label_id").cast("double").alias("label"))
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
    if layers is None:
        head = LogisticRegression(maxIter=30, regParam=0.01)
    else:
        size = rows.select(F.max(F.size(vector_to_array("raw"))).alias("d"), F.max("label").alias("k")).first()
        head = MultilayerPerceptronClassifier(layers=[size["d"], *layers, int(size["k"]) + 1], seed=seed, maxIter=30)
    return Pipeline(stages=[scaler, head]).fit(rows)


def score_windows(model, windows: DataFrame, label_id: int) -> DataFrame:
    """windows with the probability of label_id."""
    out = model.transform(windows.withColumn("raw", array_to_vector("vec")))
    return out.withColumn("score", F.get(vector_to_array("probability"), F.lit(label_id))).drop("raw", "features", "rawPrediction", "probability", "prediction")
