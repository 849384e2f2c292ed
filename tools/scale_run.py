"""Scale check: generate raw tables of any size, write them, run the model.

    python tools/scale_run.py N_CLAIMS [CPUS]

Generates N claims, N/4 policies and N/20 customers with the distributed
generator, writes them as partitioned Parquet (skew-safe layout), runs every
declared table of the model over them and prints one JSON line of timings
and per-rule failure counts observed during the writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimflow.plans.jobs import run_model  # noqa: E402
from claimflow.schemas import PARTITION_COLUMNS  # noqa: E402
from claimflow.session import build_session, scratch_path  # noqa: E402
from claimflow.sources import generate, io  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = build_session(f"local[{cpus}]", shuffle_partitions=4 * cpus)
    n_pol, n_cust = n // 4, n // 20
    t = {}
    base = scratch_path(spark, f"scale-{n}")
    t0 = time.perf_counter()
    raw = {
        "policies": generate.generate_policies(spark, n_pol, n_customers=n_cust),
        "customers": generate.generate_customers(spark, n_cust),
        "claims": generate.generate_claims(spark, n, n_policies=n_pol, n_customers=n_cust),
    }
    paths = {k: io.write_partitioned(df, f"{base}/raw/{k}", PARTITION_COLUMNS[k])
             for k, df in raw.items()}
    t["generate_and_write_raw"] = round(time.perf_counter() - t0, 1)
    t0 = time.perf_counter()
    written = run_model(spark, paths["policies"], paths["customers"], paths["claims"],
                        f"{base}/model", run_ts="2024-01-01 00:00:00")
    t["model_run"] = round(time.perf_counter() - t0, 1)
    counts = {k: spark.read.parquet(v).count() for k, v in written.items()
              if k in ("claims", "fact_claim", "dim_policy", "dim_customer", "agent_scores")}
    print(json.dumps({"n_claims": n, "cpus": cpus, "seconds": t, "rows": counts,
                      "tables": len(written)}))
    spark.stop()


if __name__ == "__main__":
    main()
