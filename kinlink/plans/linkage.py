"""The whole linkage run: train, predict, validate, package, reproduce."""

from __future__ import annotations

import argparse
import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, classifier, features, metrics, records, validate
from ..sources import provenance as prov
from ..sources import tsv

MATCHES, CANDIDATES = "matching_results.tsv", "candidate_pairs.tsv"
WORK_FILES = ["model_config.json", "training_config.json", "evaluation.json", "input_manifest.json", "expected_outputs.json"]
UNFINISHED = "[draft]"
OPTIONS = {"k": 12, "cap": 64, "mod": 1000, "keep": 20, "iterations": 600}


def read_records(spark: SparkSession, data: str | Path, split: str) -> tuple[DataFrame, DataFrame]:
    """Prepared references and targets of a split."""
    raw = [tsv.scan_source(spark, f"{data}/{split}/{split}_source{n}.tsv", n) for n in (1, 2, 3)]
    ready = [records.prepare_records(records.normalize_records(r)) for r in raw]
    return ready[0], ready[1].unionByName(ready[2])


def require_unique(rows: DataFrame, what: str) -> None:
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        raise ValueError(f"duplicate {what} ids")


def check_candidates(pairs: DataFrame, k: int) -> None:
    """No reference may have more than ``k`` candidates, or one of them twice."""
    counts = pairs.groupBy("ref_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("target_id").alias("m"))
    if not counts.where((F.col("n") > k) | (F.col("n") != F.col("m"))).isEmpty():
        raise ValueError("candidates beyond the bound, or repeated")


def candidate_features(refs: DataFrame, targets: DataFrame, k: int, cap: int, mod: int = 1, keep: int = 1):
    """Features of all candidates, persisted, and the number of pairs before the choice."""
    chosen, pairs = blocking.retrieve(refs, targets, k, cap, mod, keep)
    return features.pair_features(chosen, refs, targets).persist(), pairs


def evaluate(entities: DataFrame, scored: DataFrame) -> tuple[float, float, DataFrame]:
    """Threshold and its tuning score, and the scores of all entities at it."""
    best = metrics.choose_threshold(entities, scored).head()
    if best is None or best["threshold"] is None:
        raise ValueError("the tuning split has no entities")
    return best["threshold"], best["score"], metrics.score_entities(entities, scored, best["threshold"])


def train(spark: SparkSession, data: str, work: str, label: str = "", **options: int) -> dict:
    options = OPTIONS | options
    prov.check_write_paths(data, work)
    prov.check_options(**options)
    prov.check_inputs(data, ("train",))
    refs, targets = (x.persist() for x in read_records(spark, data, "train"))
    require_unique(refs, "reference")
    require_unique(targets, "target")
    sampled = records.select_sample(refs, options["mod"], options["keep"])
    truth = tsv.scan_truth(spark, f"{data}/train/train_ground_truth.tsv").join(
        sampled.select(F.col("id").alias("ref_id")), "ref_id", "left_semi"
    )
    if not sampled.join(truth, F.col("id") == F.col("ref_id"), "left_anti").isEmpty():
        raise ValueError("the ground truth does not cover all sampled references")
    links = metrics.explode_truth(truth).persist()
    entities = metrics.entity_table(sampled, links).persist()
    pairs, before = candidate_features(refs, targets, *(options[x] for x in ("k", "cap", "mod", "keep")))
    labelled = metrics.label_pairs(pairs, links).join(entities.select("ref_id", "split"), "ref_id")
    labelled = labelled.persist()
    classifier.check_classes(labelled)
    if entities.where("split = 'holdout'").isEmpty():
        raise ValueError("no holdout entities; increase the sample")
    part = lambda name: labelled.where(F.col("split") == name)
    model = classifier.fit(part("fitting"), options["iterations"])
    trees = classifier.best_iterations(model, part("tuning"))
    model = model.first(trees)
    scored = classifier.score(model, labelled).select("ref_id", "target_id", "label", "probability").persist()
    threshold, tuned, scores = evaluate(entities, scored)
    scores = scores.persist()
    holdout = scores.where("split = 'holdout'")
    rows = lambda df: [r.asDict(recursive=True) for r in df.collect()]
    n_refs, n_targets, n_sampled, n_pairs = refs.count(), targets.count(), sampled.count(), labelled.count()
    report = {
        "data_label": label,
        "retrieval": {
            "reference_count": n_refs,
            "target_count": n_targets,
            "preliminary_pairs": before.count(),
            "selected_references": n_sampled,
        },
        "candidate_pairs": n_pairs,
        "positive_candidates": labelled.where("label = 1").count(),
        "candidate_reduction_ratio": 1 - n_pairs / max(1, n_sampled * n_targets),
        "threshold": threshold,
        "tuning_macro_f05": tuned,
        "holdout": rows(metrics.describe(holdout))[0],
        "holdout_by_country": rows(metrics.describe(holdout, "country").orderBy("country")),
        "holdout_error_examples": rows(metrics.error_examples(scores, scored, links, threshold)),
        "feature_importance": classifier.importance(model),
        "iterations": trees,
        "options": options,
    }
    final = classifier.fit(labelled, trees)  # the metrics above are fixed before this fit
    classifier.save(final, f"{work}/model")
    config = {
        "threshold": threshold,
        "k": options["k"],
        "cap": options["cap"],
        "features": features.FEATURES,
        "model_sha256": prov.sha256_folder(f"{work}/model"),
        "code_sha256": prov.sha256_code(),
    }
    tsv.write_json(f"{work}/model_config.json", config)
    tsv.write_json(f"{work}/evaluation.json", report | {"model_sha256": config["model_sha256"]})
    tsv.write_json(f"{work}/training_config.json", options | {"data_label": label})
    tsv.write_json(f"{work}/input_manifest.json", prov.input_manifest(data, ("train",)))
    for x in (refs, targets, links, entities, pairs, labelled, scored, scores):
        x.unpersist()
    return report


def load_model(work: str) -> tuple[classifier.Trees, dict]:
    config = json.loads(Path(work, "model_config.json").read_text())
    if config["features"] != features.FEATURES:
        raise ValueError("the model was trained on other features")
    if config["model_sha256"] != prov.sha256_folder(f"{work}/model"):
        raise ValueError("the model does not match its configuration")
    return classifier.load(f"{work}/model"), config


def predict(spark: SparkSession, data: str, work: str, output: str, expected: bool = True) -> dict:
    """Write both outputs and their statistics; ``expected`` records the digests to compare with later."""
    prov.check_write_paths(data, work, output)
    prov.check_inputs(data, ("test",))
    model, config = load_model(work)
    refs, targets = (x.persist() for x in read_records(spark, data, "test"))
    require_unique(refs, "reference")
    require_unique(targets, "target")
    pairs, before = candidate_features(refs, targets, config["k"], config["cap"])
    scored = classifier.score(model, pairs).select("ref_id", "target_id", "probability").persist()
    check_candidates(scored, config["k"])
    chosen = F.col("probability") >= config["threshold"]
    tsv.write_tsv_file(tsv.id_lists(refs, scored, "candidate_entity_ids"), Path(output, CANDIDATES))
    tsv.write_tsv_file(tsv.id_lists(refs, scored, "matched_entity_ids", chosen), Path(output, MATCHES))
    stats = prediction_stats(refs, scored, chosen)
    n_targets = targets.count()
    totals = {k: sum(s[k] for s in stats) for k in ("entities", "candidates", "matches")}
    result = totals | {
        "by_country": stats,
        "average_candidates": totals["candidates"] / max(1, totals["entities"]),
        "candidate_reduction_ratio": 1 - totals["candidates"] / max(1, totals["entities"] * n_targets),
        "retrieval": {"target_count": n_targets, "preliminary_pairs": before.count()},
        "model_sha256": config["model_sha256"],
        "output_sha256": {n: prov.sha256_file(Path(output, n)) for n in (MATCHES, CANDIDATES)},
    }
    tsv.write_json(Path(output, "prediction_stats.json"), result)
    if expected:
        tsv.write_json(Path(work, "expected_outputs.json"), result["output_sha256"])
    manifest = json.loads(Path(work, "input_manifest.json").read_text())
    manifest = {k: v for k, v in manifest.items() if k.startswith("train/")} | prov.input_manifest(data, ("test",))
    tsv.write_json(Path(work, "input_manifest.json"), manifest)
    for x in (refs, targets, pairs, scored):
        x.unpersist()
    return result


def prediction_stats(refs: DataFrame, scored: DataFrame, chosen) -> list[dict]:
    counts = scored.groupBy("ref_id").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(chosen).alias("matches"))
    joined = refs.select(F.col("id").alias("ref_id"), "country").join(counts, "ref_id", "left").na.fill(0)
    by = joined.groupBy("country").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("candidates").alias("candidates"), F.sum("matches").alias("matches")
    )
    return [r.asDict() for r in by.orderBy("country").collect()]


def read_output(spark: SparkSession, path: str | Path, names: list[str]) -> DataFrame:
    """An output with each row's place in the file, counted from 0."""
    rows = tsv.scan_tsv(spark, str(path), names)
    if rows.rdd.getNumPartitions() > 1:
        raise ValueError(f"{path} is split; places cannot be told")
    return rows.withColumn("ord", F.monotonically_increasing_id())


def validate_outputs(spark: SparkSession, data: str, output: str) -> dict:
    prov.check_write_paths(data, output)
    report = Path(output, "validation.json")
    report.unlink(missing_ok=True)  # no stale pass may remain
    sources = tsv.scan_source(spark, f"{data}/test/test_source1.tsv", 1).select(F.col("entity_id").alias("id"), "ord")
    targets = [tsv.scan_source(spark, f"{data}/test/test_source{n}.tsv", n).select(F.col("entity_id").alias("id")) for n in (2, 3)]
    matches = read_output(spark, Path(output, MATCHES), ["source1_entity_id", "matched_entity_ids"])
    candidates = read_output(spark, Path(output, CANDIDATES), ["source1_entity_id", "candidate_entity_ids"])
    faults = validate.validation_faults(sources, matches, candidates, targets[0].unionByName(targets[1])).collect()
    if faults:
        raise ValueError("; ".join(f"{f['fault']}: {f['n']}, as {f['example']}" for f in faults))
    result = {"status": "PASS", "rows": sources.count()}
    tsv.write_json(report, result)
    return result


def check_provenance(data: str, work: str, output: str) -> None:
    """Model, evaluation, predictions, inputs and code must all be of one run."""
    read = lambda root, name: json.loads(Path(root, name).read_text())
    for name in WORK_FILES:
        if not Path(work, name).is_file():
            raise ValueError(f"{name} is not in the work folder")
    _, config = load_model(work)
    stats, wanted = read(output, "prediction_stats.json"), read(work, "expected_outputs.json")
    if read(work, "evaluation.json")["model_sha256"] != config["model_sha256"]:
        raise ValueError("the evaluation is that of another model")
    if stats["model_sha256"] != config["model_sha256"]:
        raise ValueError("the outputs were made by another model")
    if prov.sha256_code() != config["code_sha256"]:
        raise ValueError("the code has changed since training")
    for name in (MATCHES, CANDIDATES):
        if not prov.sha256_file(Path(output, name)) == wanted.get(name) == stats["output_sha256"].get(name):
            raise ValueError(f"{name} has changed since prediction")
    if read(work, "input_manifest.json") != prov.input_manifest(data):
        raise ValueError("an input has changed since the model was trained or used")


def package(spark: SparkSession, data: str, work: str, output: str, destination: str, document: str | None = None) -> dict:
    """A ZIP of outputs, reports, model, code and all that a reproduction needs, after validation and all checks."""
    prov.check_write_paths(data, work, output, destination)
    validate_outputs(spark, data, output)
    document = Path(document or Path(output, "report.md"))
    if not document.is_file() or UNFINISHED in document.read_text():
        raise ValueError(f"{document}: there is no finished report")
    check_provenance(data, work, output)
    parts = {f"output/{n}": Path(output, n) for n in (MATCHES, CANDIDATES, "prediction_stats.json", "validation.json")}
    parts |= {f"work/{n}": Path(work, n) for n in WORK_FILES} | {"report.md": document}
    parts |= {f"work/model/{p.relative_to(Path(work, 'model'))}": p for p in sorted(Path(work, "model").rglob("*")) if p.is_file()}
    parts |= {f"code/kinlink/{n}": p for n, p in prov.code_files().items()}
    if Path(destination).resolve() in {p.resolve() for p in parts.values()}:
        raise ValueError("the archive would overwrite one of its parts")
    manifest = {n: {"bytes": p.stat().st_size, "sha256": prov.sha256_file(p)} for n, p in parts.items()}
    temporary = Path(f"{destination}.tmp")
    try:
        with zipfile.ZipFile(temporary, "w", zipfile.ZIP_DEFLATED) as z:
            for name, p in parts.items():
                z.write(p, name)
            z.writestr("manifest.json", json.dumps(manifest, indent=2, sort_keys=True))
        with zipfile.ZipFile(temporary) as z:
            if (bad := z.testzip()) is not None:
                raise ValueError(f"the archive is damaged at {bad}")
        temporary.replace(destination)
    finally:
        temporary.unlink(missing_ok=True)
    return manifest


def unpack(archive: str, folder: str) -> str:
    """Extract an archive and compare every part with its manifest; returns the work folder in it."""
    with zipfile.ZipFile(archive) as z:
        z.extractall(folder)
    for name, entry in json.loads(Path(folder, "manifest.json").read_text()).items():
        if prov.sha256_file(Path(folder, name)) != entry["sha256"]:
            raise ValueError(f"{name} is not what the archive's manifest says")
    return str(Path(folder, "work"))


def write_document(work: str, output: str, path: str) -> str:
    """A short Markdown report of the evaluation and the outputs."""
    report = json.loads(Path(work, "evaluation.json").read_text())
    stats = json.loads(Path(output, "prediction_stats.json").read_text())
    lines = ["# Record linkage run", "", "| measure | holdout |", "|-|-|"]
    lines += [f"| {k} | {v:.6g} |" for k, v in sorted(report["holdout"].items())]
    lines += ["", f"Threshold {report['threshold']:.6g}; {report['iterations']} trees.", ""]
    lines += [f"- {k}: {stats[k]}" for k in ("entities", "candidates", "matches")]
    Path(path).write_text("\n".join(lines) + "\n")
    return path


def run(spark: SparkSession, data: str, work: str, output: str, destination: str, **options) -> dict:
    train(spark, data, work, **options)
    predict(spark, data, work, output)
    validate_outputs(spark, data, output)
    write_document(work, output, str(Path(output, "report.md")))
    return package(spark, data, work, output, destination)


def reproduce(spark: SparkSession, data: str, work: str, output: str, retrain: bool = False) -> dict:
    """Repeat prediction (and training) and compare the outputs' digests with the recorded ones.

    ``work`` may be that of an extracted archive. The verdict is written to
    ``reproduction.json``, whatever it is.
    """
    manifest = json.loads(Path(work, "input_manifest.json").read_text())
    if manifest != prov.input_manifest(data, ("train", "test")):
        raise ValueError("the inputs differ from those of the recorded run")
    wanted = json.loads(Path(work, "expected_outputs.json").read_text())
    if retrain:
        options = json.loads(Path(work, "training_config.json").read_text())
        train(spark, data, work, label=options.pop("data_label"), **options)
    predict(spark, data, work, output, expected=False)
    validate_outputs(spark, data, output)
    found = {n: prov.sha256_file(Path(output, n)) for n in wanted}
    same = found == wanted
    tsv.write_json(Path(output, "reproduction.json"), {"same": same, "retrained": retrain, "recorded": wanted, "found": found})
    if not same:
        raise ValueError("the outputs differ from the recorded run; reproduction.json has the digests")
    return found


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m kinlink.plans.linkage")
    parser.add_argument("command", choices=["train", "predict", "validate", "package", "run", "reproduce"])
    for name in ("data", "work", "output", "destination"):
        parser.add_argument(f"--{name}")
    for name, value in OPTIONS.items():
        parser.add_argument(f"--{name}", type=int, default=value)
    parser.add_argument("--label", default="")
    parser.add_argument("--retrain", action="store_true")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("kinlink").getOrCreate()
    options = {n: getattr(a, n) for n in OPTIONS} | {"label": a.label}
    done = {
        "train": lambda: train(spark, a.data, a.work, **options),
        "predict": lambda: predict(spark, a.data, a.work, a.output),
        "validate": lambda: validate_outputs(spark, a.data, a.output),
        "package": lambda: package(spark, a.data, a.work, a.output, a.destination),
        "run": lambda: run(spark, a.data, a.work, a.output, a.destination, **options),
        "reproduce": lambda: reproduce(spark, a.data, a.work, a.output, a.retrain),
    }[a.command]()
    print(json.dumps(done, indent=2, sort_keys=True, default=str))


if __name__ == "__main__":
    main()
