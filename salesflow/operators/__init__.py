"""DataFrame operators, by SURVEY §2 section.

blocks      shared building blocks (prefix sums, row index, exact quantiles, moments, attach)
summary     A1-A21 aggregations and summaries
relational  P1-P13 projection / filter / top-N, J1-J5 joins, U1-U3 unions
windows     W1-W8 lags, rolling statistics, hopping windows, row index, ranks, latest-per-key
features    F1-F7 calendar, interaction, group and serving features, demand index
preprocess  T1-T10 split, scale, encode, impute, outliers, pipeline
quality     Q1-Q18 data-quality report, gate, record validation
selection   FS1-FS10 feature selection
models      M1-M13 metrics, run / version tables, MLlib training and scoring, X1
drift       D1-D7 KS, p-value, PSI, bands, history, monitoring run
monitor     PM1-PM7 performance vs baseline, trend, retrain decision, alerts, summary
udf         X2 per-group pandas functions on bounded chunks
"""
