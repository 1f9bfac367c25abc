"""Daily staffing metrics (per facility-day row, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rosterline import schemas as S
from rosterline.functions.metrics import guarded_pct, guarded_ratio, sum_of


def with_daily_metrics(staffing: DataFrame) -> DataFrame:
    """Append the seven derived daily columns.

    * total / contract direct hours: RN + LPN + CNA with NULL counted as 0
    * RN / LPN / CNA HPRD: hours / census where census > 0; a NULL hour stays NULL
    * total direct HPRD: coalesced total / census where census > 0
    * contract dependency %: contract / total * 100 where total > 0
    """
    total = sum_of([S.hrs(r) for r in S.DIRECT_ROLES])
    contract = sum_of([S.hrs(r, "_ctr") for r in S.DIRECT_ROLES])
    return staffing.select(
        "*",
        total.alias("total_direct_hours"),
        contract.alias("contract_direct_hours"),
        guarded_ratio(S.hrs("RN"), "mdscensus").alias("rn_hprd"),
        guarded_ratio(S.hrs("LPN"), "mdscensus").alias("lpn_hprd"),
        guarded_ratio(S.hrs("CNA"), "mdscensus").alias("cna_hprd"),
        guarded_ratio(total, "mdscensus").alias("total_direct_hprd"),
        guarded_pct(contract, total).alias("contract_dependency_pct"),
    )
