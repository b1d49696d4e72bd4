"""Benchmark the headline stages at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
Each stage is forced with a ``noop`` write (full computation, no collect) or a
small collect, timed as the median of $BENCH_REPEATS runs after one warm-up;
the 12-fit grid likewise ($BENCH_GRID_REPEATS, default 2).  The same grid then
runs once on one distinct text per order, about as many rows as the published
run had; it is left out of the total, stopped after $BENCH_LARGE_SECONDS (400)
and, with $BENCH_LARGE_GRID=0, not run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# The reference's published grid timing (context only).
REFERENCE_GRID_SECONDS = 196.23
REFERENCE_GRID_ROWS = 138772


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    grid_repeats = int(os.environ.get("BENCH_GRID_REPEATS", "2"))

    from polarity.session import get_session, materialize
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)

    from polarity.operators import dedup, features as feat, metrics as mx, models, quality, score, split
    from polarity.plans import job
    from polarity.sources import fixtures as fx

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    posts = materialize(fx.posts(spark, sf_dir))
    reviews = materialize(fx.reviews(spark, sf_dir))
    scored = materialize(fx.scored(spark, sf_dir))
    clean, _ = job.preprocess(posts)
    clean = materialize(clean)
    table = materialize(split.stratified_split(clean))
    train, val = job.part(table, "train"), job.part(table, "validation")
    baseline, _ = models.train_baseline(train, val)
    unlabelled = materialize(fx.unlabelled(spark, sf_dir))
    n_unlabelled = unlabelled.count()

    stages = {
        "profile": lambda: quality.profile(posts).collect(),
        "preprocess": lambda: noop(dedup.preprocess_plan(posts).clean),
        "cleaning_report": lambda: dedup.preprocess_plan(posts).report.collect(),
        "split": lambda: noop(split.stratified_split(clean)),
        "tfidf_long": lambda: noop(feat.tfidf_long(reviews, feat.BASELINE_TFIDF, text_col="text")),
        "char_tfidf_long": lambda: noop(feat.tfidf_long(
            reviews, feat.VARIANTS["real_word_char_hybrid"].parts[1], text_col="text")),
        "threshold_sweep": lambda: mx.threshold_sweep(scored).collect(),
        "error_analysis": lambda: mx.top_errors(mx.error_table(scored.withColumn(
            "prediction", mx.default_decision(scored["negative_probability"], scored["positive_probability"]))), 100).collect(),
        "score_batch": lambda: noop(score.score(unlabelled, baseline, 0.47, keep=("row_id",))),
    }
    timings = {}
    for name, fn in stages.items():
        fn()  # warm-up
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)

    grid_runs, boards = [], []
    for i in range(grid_repeats + 1):
        t0 = time.perf_counter()
        board, _ = models.run_experiments(train, val)
        rows = board.collect()
        if i:  # the first run is the warm-up
            grid_runs.append(time.perf_counter() - t0)
            boards.append(rows)
    timings["experiment_grid_12_fits"] = round(statistics.median(grid_runs), 3)
    print(f"experiment_grid_12_fits: {timings['experiment_grid_12_fits']}s", file=sys.stderr, flush=True)

    large = None
    if os.environ.get("BENCH_LARGE_GRID", "1") != "0":
        notes = materialize(fx.order_notes(spark, sf_dir))
        large_train, large_val = (materialize(notes.where(f"row_id % 40 {op} 0")) for op in ("<>", "="))
        rows, limit = large_train.count(), float(os.environ.get("BENCH_LARGE_SECONDS", "400"))
        over = threading.Event()

        def stop_when_over():
            over.wait(limit)
            while not over.wait(1.0):       # a job may start between two calls
                spark.sparkContext.cancelAllJobs()

        threading.Thread(target=stop_when_over, daemon=True).start()
        t0 = time.perf_counter()
        try:
            large_board = models.run_experiments(large_train, large_val)[0].collect()
            seconds = time.perf_counter() - t0
            large = {"train_rows": rows, "seconds": round(seconds, 1), "train_rows_per_sec": round(rows * 12 / seconds, 1),
                     "fit_seconds": {r.experiment_name: round(r.training_time_seconds, 1) for r in large_board},
                     "relative_gradient": {r.experiment_name: r.relative_gradient for r in large_board}}
        except Exception:
            if time.perf_counter() - t0 < limit:
                raise
            large = {"train_rows": rows, "seconds": f"stopped after {limit}"}
        finally:
            over.set()
        print(f"large grid: {large['seconds']}s", file=sys.stderr, flush=True)

    out = {
        "metric": "total_stage_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": int(cpus),
        "rows": {"posts": posts.count(), "clean": clean.count(), "train": train.count(),
                 "reviews": reviews.count(), "unlabelled": n_unlabelled},
        "score_rows_per_sec": round(n_unlabelled / timings["score_batch"], 1) if timings["score_batch"] else None,
        "grid_fit_seconds": {r.experiment_name: round(r.training_time_seconds, 3) for r in boards[-1]},
        "grid_train_rows_per_sec": round(train.count() * 12 / timings["experiment_grid_12_fits"], 1),
        "large_grid": large,
        "reference_grid_12_fits_sec": REFERENCE_GRID_SECONDS,
        "reference_grid_train_rows_per_sec": round(REFERENCE_GRID_ROWS * 12 / REFERENCE_GRID_SECONDS, 1),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
