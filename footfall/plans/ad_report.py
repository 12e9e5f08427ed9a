"""Ad statistics over stored clicks: the batch form of the streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from footfall.operators import ads


@dataclass(frozen=True)
class AdReport:
    blacklist: DataFrame
    ad_stat: DataFrame
    province_top3: DataFrame
    click_trend: DataFrame


def ad_report(
    clicks: DataFrame, threshold: int = ads.BLACKLIST_THRESHOLD, filtered_trend: bool = False
) -> AdReport:
    """Counts and top lists of the clicks made before their user was blacklisted.

    The trend counts all clicks unless ``filtered_trend`` is set.
    """
    kept = ads.blacklist_cutoff(clicks, threshold)
    stat = ads.ad_stat(kept)
    return AdReport(
        blacklist=ads.blacklist_users(ads.daily_user_ad_count(clicks), threshold),
        ad_stat=stat,
        province_top3=ads.province_top3(ads.province_ad_count(stat)),
        click_trend=ads.ad_click_trend(kept if filtered_trend else clicks),
    )
