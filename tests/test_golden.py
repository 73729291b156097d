"""Golden figures published with the original analysis, copied here as fixed values."""

from fundlens.plans import segment as sg

# Per-cluster profile of the published 50-fund segmentation
# (cluster_id, fund_count, avg_return, avg_vol, avg_sharpe, avg_aum_m, avg_anomalies, consistency)
PUBLISHED_PROFILE = [
    (0, 18, 0.0066, 0.0319, 0.0746, 914.8837, 10.5556, 0.5870),
    (1, 7, 0.0126, 0.0657, 0.0627, 422.1995, 15.1429, 0.5762),
    (2, 9, -0.0003, 0.0601, -0.0021, 723.7418, 13.6667, 0.4981),
    (3, 5, 0.0104, 0.0072, 0.5393, 5487.2339, 14.4000, 0.9167),
    (4, 11, 0.0137, 0.0477, 0.1020, 1503.0307, 15.9091, 0.6318),
]
PUBLISHED_LABELS = {0: "Cluster 0", 1: "Cluster 1", 2: "Underperformers",
                    3: "Large Cap Stable", 4: "High Operational Risk"}
# First and last point of the published 90-day forecast
FORECAST_FIRST, FORECAST_LAST = 8.144553e10, 8.582655e10


def test_published_labels_reproduced(spark):
    prof = spark.createDataFrame(PUBLISHED_PROFILE, "cluster_id int, fund_count long, avg_return double, "
                                 "avg_vol double, avg_sharpe double, avg_aum_m double, "
                                 "avg_anomalies double, consistency double")
    got = {r["cluster_id"]: r["cluster_label"] for r in sg.label_clusters(prof).collect()}
    assert got == PUBLISHED_LABELS
    assert sum(p[1] for p in PUBLISHED_PROFILE) == 50


def test_published_forecast_trend_bound():
    assert abs(FORECAST_LAST - FORECAST_FIRST) / FORECAST_FIRST < 0.5
