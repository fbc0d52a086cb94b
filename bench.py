"""Headline benchmark: L1 (feature store), S7 (six-table write), L2
(supervised sequences), L3 (train + predict) and the raw-row window
operators, on $BENCH_SF_DIR with local[$BENCH_CPUS].  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from nextcat.config import FIXTURE_SPLIT, ModelConfig, SequenceConfig  # noqa: E402
from nextcat.operators.trends import number_transactions, running_balance  # noqa: E402
from nextcat.plans.feature_store import build_feature_store, narrow_tables  # noqa: E402
from nextcat.plans.model import train_and_predict  # noqa: E402
from nextcat.plans.supervised import supervised_sequences  # noqa: E402
from nextcat.session import build_session, scratch_path  # noqa: E402
from nextcat.sources import io as IO  # noqa: E402
from nextcat.sources.fixtures import TPCH_CONFIG, order_ledger, tpch_transactions  # noqa: E402


def _sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    txn = tpch_transactions(spark, sf_dir)
    # warm-up: JVM start, file listing, code generation caches
    _sink(txn.limit(1000))

    def l1():
        fs, cfg = build_feature_store(txn, TPCH_CONFIG)
        _sink(fs)
        return fs, cfg
    fs, cfg = timed("l1_feature_store", l1)

    base = scratch_path(spark, "bench-fs")
    paths = timed("s7_write_tables", lambda: IO.write_feature_store(fs, narrow_tables(fs, cfg), base))
    stored = IO.read_partitioned(spark, paths["feature_store"])
    seq = SequenceConfig(seq_len=3)
    timed("l2_supervised_sequences", lambda: _sink(supervised_sequences(stored, cfg, seq, FIXTURE_SPLIT)))
    timed("l3_train_predict", lambda: _sink(train_and_predict(stored, cfg, seq, FIXTURE_SPLIT, ModelConfig())[1]))
    timed("w6_running_balance", lambda: _sink(running_balance(order_ledger(spark, sf_dir))))
    timed("w8_txn_number", lambda: _sink(number_transactions(
        txn.select("customer_id", "timestamp", "order_key", "line_number", "amount"), "customer_id",
        order=("timestamp", "order_key", "line_number", "amount"))))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
