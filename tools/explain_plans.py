"""Print the physical plans (explain "formatted") of the key operators.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import sys
import tempfile

sys.path.insert(0, ".")

from pulsegrid.config import PROFILE_A  # noqa: E402
from pulsegrid.operators import serving as SE  # noqa: E402
from pulsegrid.operators import silver as SV  # noqa: E402
from pulsegrid.operators import snapshots as SN  # noqa: E402
from pulsegrid.session import get_session  # noqa: E402
from pulsegrid.sources.adapters import BRONZE, bronze_master  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    out = tempfile.mkdtemp(prefix="pulsegrid-explain-")
    sv = {}
    for ch in ("email", "web", "event", "rep"):
        SV.to_silver(BRONZE[ch](spark, sf), SV.SPECS[ch]).write.parquet(f"{out}/{ch}")
        sv[ch] = spark.read.parquet(f"{out}/{ch}")
    ids = bronze_master(spark, sf).select("hcp_id").distinct()
    plans = {
        "silver web (dedup: partial WindowGroupLimit before the exchange)": SV.to_silver(BRONZE["web"](spark, sf), SV.SPECS["web"]),
        "rep history (pushed ts bounds, pane states, dates after the fold)": SN.channel_history(sv["rep"], "rep", PROFILE_A),
        "snapshot features A (spine explode + co-partitioned left joins)": SN.snapshot_features(sv, ids, None, PROFILE_A),
        "paging (bucketed row numbers, broadcast offsets)": SE.paginate(sv["email"], "email_event_id", 3, 100)[0],
    }
    for title, df in plans.items():
        print("=" * 100)
        print(title)
        print("=" * 100)
        df.explain("formatted")


if __name__ == "__main__":
    main()
