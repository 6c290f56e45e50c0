"""Schemas and fixed value lists."""

from __future__ import annotations

from pyspark.sql import types as T

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

LABELLED_EDGE_SCHEMA = T.StructType(EDGE_SCHEMA.fields + [T.StructField("label", T.ShortType())])

LABEL_SCHEMA = T.StructType([T.StructField("label", T.ShortType())])

SCORE_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("is_alert", T.BooleanType()),
        T.StructField("label", T.ShortType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

ALERT_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("subgraph_nodes", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
    ]
)

BENIGN = "Benign"

# Raw flow labels and the class each one stands for.
LABEL_CLASSES = {
    "BENIGN": "Benign",
    "benign": "Benign",
    "Benign": "Benign",
    "DDoS": "DDoS",
    "DDOS": "DDoS",
    "Port Scan": "PortScan",
    "port scan": "PortScan",
    "PortScan": "PortScan",
    "Bot": "Bot",
    "BOT": "Bot",
    "Botnet": "Bot",
    "SSH-Bruteforce": "BruteForce-SSH",
    "Brute Force": "BruteForce",
    "brute force": "BruteForce",
    "Web Attack - Brute Force": "WebAttack-BruteForce",
    "Web Attack - XSS": "WebAttack-XSS",
    "Web Attack - Sql Injection": "WebAttack-SQLi",
    "Infiltration": "Infiltration",
    "DoS Hulk": "DoS-Hulk",
    "DoS Slowhttptest": "DoS-Slowhttptest",
    "DoS Slowloris": "DoS-Slowloris",
    "DoS GoldenEye": "DoS-GoldenEye",
}

# Timestamp layouts found in flow files, tried in this order.
TIMESTAMP_FORMATS = (
    "d/M/yyyy H:m:s",
    "d/M/yyyy h:m:s a",
    "yyyy-M-d H:m:s",
    "yyyy-M-d h:m:s a",
)

# Numeric flow columns of the public labelled-flow dataset.
NUMERIC_FEATURES = (
    "Flow Duration",
    "Total Fwd Packets",
    "Total Bwd Packets",
    "Total Length of Fwd Packets",
    "Total Length of Bwd Packets",
    "Fwd Packet Length Max",
    "Fwd Packet Length Min",
    "Fwd Packet Length Mean",
    "Fwd Packet Length Std",
    "Bwd Packet Length Max",
    "Bwd Packet Length Min",
    "Bwd Packet Length Mean",
    "Bwd Packet Length Std",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Flow IAT Mean",
    "Flow IAT Std",
    "Flow IAT Max",
    "Flow IAT Min",
    "Fwd IAT Total",
    "Fwd IAT Mean",
    "Fwd IAT Std",
    "Fwd IAT Max",
    "Fwd IAT Min",
    "Bwd IAT Total",
    "Bwd IAT Mean",
    "Bwd IAT Std",
    "Bwd IAT Max",
    "Bwd IAT Min",
    "Fwd PSH Flags",
    "Bwd PSH Flags",
    "Fwd URG Flags",
    "Bwd URG Flags",
    "Fwd Header Length",
    "Bwd Header Length",
    "Fwd Packets/s",
    "Bwd Packets/s",
    "Min Packet Length",
    "Max Packet Length",
    "Packet Length Mean",
    "Packet Length Std",
    "Packet Length Variance",
    "FIN Flag Count",
    "SYN Flag Count",
    "RST Flag Count",
    "PSH Flag Count",
    "ACK Flag Count",
    "URG Flag Count",
    "CWE Flag Count",
    "ECE Flag Count",
    "Down/Up Ratio",
    "Average Packet Size",
    "Avg Fwd Segment Size",
    "Avg Bwd Segment Size",
    "Fwd Avg Bytes/Bulk",
    "Fwd Avg Packets/Bulk",
    "Fwd Avg Bulk Rate",
    "Bwd Avg Bytes/Bulk",
    "Bwd Avg Packets/Bulk",
    "Bwd Avg Bulk Rate",
    "Subflow Fwd Packets",
    "Subflow Fwd Bytes",
    "Subflow Bwd Packets",
    "Subflow Bwd Bytes",
    "Init_Win_bytes_forward",
    "Init_Win_bytes_backward",
    "act_data_pkt_fwd",
    "min_seg_size_forward",
    "Active Mean",
    "Active Std",
    "Active Max",
    "Active Min",
    "Idle Mean",
    "Idle Std",
    "Idle Max",
    "Idle Min",
)

# The flow columns profiled by the attribute analysis.
PROFILE_FEATURES = (
    "Flow Duration",
    "Total Fwd Packets",
    "Total Bwd Packets",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Fwd Packet Length Mean",
    "Bwd Packet Length Mean",
    "Packet Length Mean",
    "Flow IAT Mean",
    "Fwd IAT Mean",
    "Bwd IAT Mean",
    "FIN Flag Count",
    "SYN Flag Count",
    "RST Flag Count",
    "ACK Flag Count",
    "Fwd PSH Flags",
    "Bwd PSH Flags",
    "Down/Up Ratio",
    "Average Packet Size",
    "Init_Win_bytes_forward",
)

# Flow columns that are not sent as features of a replayed event.
REPLAY_CORE_COLUMNS = (
    "Source IP",
    "Destination IP",
    "Timestamp",
    "Label",
    "is_attack",
    "attack_type",
    "Flow ID",
)
