"""Command-line entry points for the scheduled jobs.

    python -m respawn.jobs ingest  --landing DIR --root DIR
    python -m respawn.jobs silver  --root DIR [--stream | --incremental]
    python -m respawn.jobs gold    --root DIR [--as-of YYYY-MM-DD]
    python -m respawn.jobs history --root DIR --start D --end D
    python -m respawn.jobs train   --root DIR --models DIR [--algorithm random_forest|logistic_regression]
                                   [--max-depth 8] [--num-trees 80] [--promote]
                                   [--label recency|next_week]
    python -m respawn.jobs training --root DIR --as-of D          (features to D, label from the week after)
    python -m respawn.jobs sweep   --root DIR --models DIR [--max-depth 4 8] [--num-trees 40 80]
    python -m respawn.jobs score   --root DIR --models DIR
    python -m respawn.jobs bi      --root DIR                     (stored dashboard views)
    python -m respawn.jobs catalog --root DIR

``--root`` and ``--models`` must be folders on the cluster's shared filesystem;
``spark.checkpoint.dir`` must be set on a cluster (see respawn.session).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from respawn.constants import RF_MAX_DEPTH, RF_NUM_TREES


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="respawn.jobs")
    ap.add_argument("job", choices=["ingest", "silver", "gold", "history", "training", "train", "sweep", "score", "bi", "catalog"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--landing")
    ap.add_argument("--models")
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--stream", action="store_true", help="silver as an incremental stream")
    ap.add_argument("--incremental", action="store_true", help="silver by batch, rewriting only the dates that new bronze touches")
    ap.add_argument("--algorithm", default="random_forest", choices=["random_forest", "logistic_regression"])
    ap.add_argument("--max-depth", type=int, nargs="+", default=[RF_MAX_DEPTH])
    ap.add_argument("--num-trees", type=int, nargs="+", default=[RF_NUM_TREES])
    ap.add_argument("--label", default="recency", choices=["recency", "next_week"])
    ap.add_argument("--max-files", type=int, help="files per ingest micro-batch")
    ap.add_argument("--promote", action="store_true")
    a = ap.parse_args(argv)

    from respawn.plans import layers
    from respawn.session import build_session
    spark = build_session(app=f"respawn-{a.job}")
    out: dict = {"job": a.job}
    if a.job == "ingest":
        out.update(layers.build_bronze(spark, a.landing, a.root, a.max_files))
    elif a.job == "silver":
        out.update(layers.build_silver(spark, a.root, stream=a.stream, incremental=a.incremental))
    elif a.job == "gold":
        layers.build_gold(spark, a.root, a.as_of)
    elif a.job == "history":
        layers.build_history(spark, a.root, a.start, a.end)
    elif a.job == "training":
        layers.build_training(spark, a.root, a.as_of)
    elif a.job == "sweep":
        from respawn.operators import bi, ml
        churn = bi.latest_snapshot(spark.read.parquet(f"{a.root}/gold/churn_features_daily"))
        grid = [{"max_depth": d, "num_trees": n} for d in a.max_depth for n in a.num_trees]
        out["grid"] = [{k: x[k] for k in ("max_depth", "num_trees", "auc", "accuracy", "f1", "auc_mean", "auc_std")} for x in ml.sweep(churn, grid)]
    elif a.job == "bi":
        layers.bi_views(spark, a.root)
    elif a.job == "train":
        from respawn.operators import bi, ml
        table = "churn_training" if a.label == "next_week" else "churn_features_daily"
        churn = bi.latest_snapshot(spark.read.parquet(f"{a.root}/gold/{table}"))
        params = {"max_depth": a.max_depth[0], "num_trees": a.num_trees[0]} if a.algorithm == "random_forest" else {}
        model, metrics, _ = ml.train_churn_model(churn, a.algorithm, **params)
        run = ml.register_model(spark, model, metrics, {"algorithm": a.algorithm, **params}, a.models)
        if a.promote:
            ml.promote(spark, a.models, run["run_id"])
        out.update({"run_id": run["run_id"], **{k: metrics[k] for k in ("auc", "accuracy", "f1")}})
    elif a.job == "score":
        layers.build_scores(spark, a.root, a.models)
    elif a.job == "catalog":
        out["tables"] = layers.register_catalog(spark, a.root)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
