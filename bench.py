"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the local cores. Each query runs once to warm up
and BENCH_RUNS times (default 1) for the reported best. ``catalogue_*`` entries load the catalogue once
(star tables and documents, written as Parquet) and query what was written, the way a user works;
all others build everything they need from the driver tables within the measured time.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marquee.operators import documents as D  # noqa: E402
from marquee.operators import normalize as N  # noqa: E402
from marquee.plans import directors, films  # noqa: E402
from marquee.session import build_session, ensure_shared_dir, shared_path  # noqa: E402
from marquee.sinks import layout, publish  # noqa: E402
from marquee.verify import registry as R  # noqa: E402
from marquee.verify import shapes as V  # noqa: E402

HEADLINE = [
    "titles_clean", "ratings_clean", "title_genres_bridge", "title_principals_bridge", "title_crew_bridge",
    "episodes_clean", "table_counts", "director_info", "director_movies", "title_documents", "embed_principals",
    "collapse_last_non_null", "film_card", "film_search", "director_works", "director_works_titles", "top_rated",
    "top_rated_details", "top_directors", "top_actors", "top_actors_staging", "phrase_search", "token_search",
    "trigram_terms", "upsert_replace", "insert_ignore", "upsert_sparse", "batches_fold", "fk_violations",
    "cascade_delete", "snapshot_diff", "apply_changes", "rebuild_chain", "restore_chain", "backup_list",
    "backup_retention", "backup_bases", "backup_orphans", "log_durations", "stream_upsert",
]


def timed(action, runs: int) -> float:
    best = None
    for _ in range(runs):
        start = time.perf_counter()
        action()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return round(best, 4)


def drain(df) -> None:
    """Compute every row and column without collecting."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "marquee-bench", master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="marquee-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(spark)
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    times: dict[str, float] = {}

    for name in HEADLINE:
        if not only or name in only:
            run = R.QUERIES[name]
            drain(run(spark, folder))
            times[name] = timed(lambda: drain(run(spark, folder)), runs)

    if not only or "catalogue" in only:
        root, docs = shared_path(spark, "bench-star"), shared_path(spark, "bench-docs")
        staging = V.staging(spark, folder)
        times["catalogue_load_star"] = timed(lambda: publish.publish(
            spark, root, lambda store: N.build_star(staging, store=store), write=layout.write_star), 1)

        times["catalogue_load_documents"] = timed(lambda: publish.publish(
            spark, docs, lambda store: D.build_documents(staging, store=store), write=layout.write_documents), 1)
        star, stored = publish.current(spark, root), publish.current(spark, docs)
        titles, people = stored["titles"], stored["people"]
        queries = {
            "director_info": lambda: directors.director_info(star, R.DIRECTOR),
            "director_movies": lambda: directors.director_movies(star, R.DIRECTOR),
            "director_works": lambda: films.director_works(titles, people, R.DIRECTOR_RAW),
            "director_works_titles": lambda: films.director_works_titles(titles, people, R.DIRECTOR_RAW),
            "top_rated": lambda: films.top_rated(titles),
            "top_rated_details": lambda: films.top_rated_details(titles, people),
            "top_directors": lambda: films.top_directors(titles, people),
            "top_actors": lambda: films.top_actors(titles, people),
            "film_card": lambda: films.film_card(stored, R.PHRASE),
            "film_search": lambda: films.film_search(stored, "may specified"),
        }
        for name, build in queries.items():
            drain(build())
            times[f"catalogue_{name}"] = timed(lambda: drain(build()), runs)

    spark.stop()
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
