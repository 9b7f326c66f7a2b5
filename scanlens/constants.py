"""Feature contract, thresholds, windows, scan profiles, column maps.

Everything here has to equal the published behaviour exactly, so it is written
down as plain data.  Limits that steer the physical plan live in ``limits.py``.
"""

from __future__ import annotations

# --- Fixed values: feature contract (order is the schema) -----------------------
# (short name used inside the engine, name used in flow files)
FEATURE_COLUMNS = [
    ("dst_port", "Destination Port"),
    ("flow_duration", "Flow Duration"),
    ("total_fwd_packets", "Total Fwd Packets"),
    ("syn_flag_count", "SYN Flag Count"),
    ("rst_flag_count", "RST Flag Count"),
    ("ack_flag_count", "ACK Flag Count"),
    ("flow_iat_mean", "Flow IAT Mean"),
    ("bwd_packet_length_mean", "Bwd Packet Length Mean"),
    ("init_win_bytes_forward", "Init_Win_bytes_forward"),
]
FEATURES = [short for short, _ in FEATURE_COLUMNS]
DEFENCE_FEATURES = ["shadow_node_interaction", "mtd_port_delta"]
MODEL_FEATURES = FEATURES + DEFENCE_FEATURES

# --- Fixed values: labels, thresholds, windows, seeds ---------------------------
ATTACK_LABEL = "PortScan"
BENIGN_LABEL = "BENIGN"
DEFAULT_SOURCE_IP = "192.168.100.10"
DEFAULT_SCAN_TYPE = "SYN Scan"
LOOPBACK_SOURCES = ["127.0.0.1", "0.0.0.0", "localhost"]
BLOCK_THRESHOLD = 0.85
ALERT_THRESHOLD = 0.60
FAST_WINDOW_SECONDS = 10
SLOW_WINDOW_SECONDS = 60
SLOW_WINDOW_SLIDE_SECONDS = 10
REFRESH_SECONDS = 2
BLOCK_TTL_MINUTES = 30
THREAT_WINDOW_SECONDS = 300
ROTATION_SECONDS = 30
SESSION_GAP_SECONDS = 300
WATERMARK = "10 minutes"
REPEAT_SECONDS = 600
SEED = 42
TEST_SHARE = 0.2
CV_FOLDS = 10
SMOTE_NEIGHBOURS = 5
FALLBACK_PORT_GROUPS = 50

# --- Fixed values: label patterns used when aligning foreign data ---------------
RECON_PATTERN = "recon|portscan|port scan|infilteration"
BENIGN_PATTERN = "benign"
RECON_CATEGORY = "reconnaissance"

# --- Fixed values: deception events ---------------------------------------------
REDIRECT_EVENT = "REDIRECT"
BLACKLIST_EVENT = "BLACKLIST"
MUTATION_EVENTS = ["MUTATE", "ROTATE_DONE"]
DECOY_PROFILES = [
    "data_leak",
    "shell_mimicry",
    "credential_harvest",
    "ssh_latency",
    "tool_breaker",
]
STEALTH_FLAGS = ["F", "FPU", ""]

# --- Fixed values: acceptance criteria ------------------------------------------
SUPERVISED_CRITERIA = {"f1_score": 0.88, "accuracy": 0.90, "fpr": 0.06}
UNSUPERVISED_CRITERIA = {"f1_score": 0.60, "accuracy": 0.60, "recall": 0.70}

# --- Fixed values: synthetic defence telemetry ----------------------------------
SHADOW_RATE = {1: 0.15, 0: 0.02}
PORT_DELTA_RANGE = {1: 1024, 0: 128}

# --- Fixed values: flow profile per scan type (rule order matters) --------------
SCAN_PROFILE_FIELDS = [
    "scan_type", "flow_duration", "total_fwd_packets", "syn_flag_count", "rst_flag_count",
    "ack_flag_count", "flow_iat_mean", "bwd_packet_length_mean", "init_win_bytes_forward",
]
SCAN_PROFILES = [
    ("syn", 5000, 1, 1, 1, 0, 5000, 40, 1024),
    ("full", 6000, 1, 1, 1, 0, 6000, 40, 1024),
    ("service", 11000, 10, 1, 0, 9, 1100, 200, 1024),
    ("os", 16000, 20, 5, 0, 15, 800, 150, 1024),
    ("aggressive", 22000, 30, 5, 0, 25, 733, 180, 1024),
    ("udp", 20000, 50, 0, 0, 0, 400, 0, 0),
    ("xmas", 6000, 1, 0, 0, 0, 6000, 0, 1024),
    ("slow", 505000, 1000, 1000, 998, 0, 505000, 40, 1024),
    ("fast", 4660, 1, 1, 1, 0, 4660, 40, 1024),
    ("very_fast", 4660, 1, 1, 1, 0, 4660, 40, 1024),
]
DEFAULT_SCAN_PROFILE = "syn"

# --- Fixed values: wide feature set (target, source column of the flow file) ----
# "Unique Dst IPs/Src" is derived (distinct ports per source) and has no source.
WIDE_FEATURES = [
    ("Distinct Dst Ports/IP", "Destination Port"),
    ("Unique Dst IPs/Src", None),
    ("Flow Duration", "Flow Duration"),
    ("Total Fwd Packets", "Total Fwd Packets"),
    ("SYN Flag Count", "SYN Flag Count"),
    ("RST Flag Count", "RST Flag Count"),
    ("ACK Flag Count", "ACK Flag Count"),
    ("IAT Mean", "Flow IAT Mean"),
    ("TTL Value", "Init_Win_bytes_backward"),
    ("TCP Window Size", "Init_Win_bytes_forward"),
    ("Total Bwd Packets", "Total Backward Packets"),
    ("Fwd Packet Length Mean", "Fwd Packet Length Mean"),
    ("Bwd Packet Length Mean", "Bwd Packet Length Mean"),
    ("Flow Bytes/s", "Flow Bytes/s"),
    ("Flow Packets/s", "Flow Packets/s"),
    ("Fwd IAT Mean", "Fwd IAT Mean"),
    ("Bwd IAT Mean", "Bwd IAT Mean"),
    ("Min Packet Length", "Min Packet Length"),
    ("Max Packet Length", "Max Packet Length"),
    ("Packet Length Mean", "Packet Length Mean"),
    ("Packet Length Std", "Packet Length Std"),
    ("FIN Flag Count", "FIN Flag Count"),
    ("PSH Flag Count", "PSH Flag Count"),
    ("URG Flag Count", "URG Flag Count"),
    ("Fwd Header Length", "Fwd Header Length"),
    ("Bwd Header Length", "Bwd Header Length"),
    ("Down/Up Ratio", "Down/Up Ratio"),
    ("Average Packet Size", "Average Packet Size"),
    ("Avg Fwd Segment Size", "Avg Fwd Segment Size"),
    ("Avg Bwd Segment Size", "Avg Bwd Segment Size"),
    ("Subflow Fwd Packets", "Subflow Fwd Packets"),
    ("Subflow Fwd Bytes", "Subflow Fwd Bytes"),
    ("Subflow Bwd Packets", "Subflow Bwd Packets"),
    ("Subflow Bwd Bytes", "Subflow Bwd Bytes"),
    ("Init_Win_bytes_forward", "Init_Win_bytes_forward"),
    ("Init_Win_bytes_backward", "Init_Win_bytes_backward"),
    ("act_data_pkt_fwd", "act_data_pkt_fwd"),
    ("min_seg_size_forward", "min_seg_size_forward"),
    ("Active Mean", "Active Mean"),
    ("Idle Mean", "Idle Mean"),
    ("Fwd Packets/s", "Fwd Packets/s"),
    ("Bwd Packets/s", "Bwd Packets/s"),
    ("Fwd Packet Length Max", "Fwd Packet Length Max"),
    ("Bwd Packet Length Max", "Bwd Packet Length Max"),
    ("ECE Flag Count", "ECE Flag Count"),
    ("CWE Flag Count", "CWE Flag Count"),
]
WIDE_DEFENCE_FEATURES = ["Shadow Node Interaction", "MTD Port Delta"]

# --- Fixed values: alignment maps (target -> source column | constant | None) ---
FLOWMETER_V3_MAP = {
    "Distinct Dst Ports/IP": "Dst Port",
    "Unique Dst IPs/Src": "Dst Port",
    "Flow Duration": "Flow Duration",
    "Total Fwd Packets": "Tot Fwd Pkts",
    "SYN Flag Count": "SYN Flag Cnt",
    "RST Flag Count": "RST Flag Cnt",
    "ACK Flag Count": "ACK Flag Cnt",
    "IAT Mean": "Flow IAT Mean",
    "TTL Value": "Bwd IAT Mean",
    "TCP Window Size": "Init Fwd Win Byts",
    "Total Bwd Packets": "Tot Bwd Pkts",
    "Fwd Packet Length Mean": "Fwd Pkt Len Mean",
    "Bwd Packet Length Mean": "Bwd Pkt Len Mean",
    "Flow Bytes/s": "Flow Byts/s",
    "Flow Packets/s": "Flow Pkts/s",
    "Fwd IAT Mean": "Fwd IAT Mean",
    "Bwd IAT Mean": "Bwd IAT Mean",
    "Min Packet Length": "Pkt Len Min",
    "Max Packet Length": "Pkt Len Max",
    "Packet Length Mean": "Pkt Len Mean",
    "Packet Length Std": "Pkt Len Std",
    "FIN Flag Count": "FIN Flag Cnt",
    "PSH Flag Count": "PSH Flag Cnt",
    "URG Flag Count": "URG Flag Cnt",
    "Fwd Header Length": "Fwd Header Len",
    "Bwd Header Length": "Bwd Header Len",
    "Down/Up Ratio": "Down/Up Ratio",
    "Average Packet Size": "Pkt Size Avg",
    "Avg Fwd Segment Size": "Fwd Seg Size Avg",
    "Avg Bwd Segment Size": "Bwd Seg Size Avg",
    "Subflow Fwd Packets": "Subflow Fwd Pkts",
    "Subflow Fwd Bytes": "Subflow Fwd Byts",
    "Subflow Bwd Packets": "Subflow Bwd Pkts",
    "Subflow Bwd Bytes": "Subflow Bwd Byts",
    "Init_Win_bytes_forward": "Init Fwd Win Byts",
    "Init_Win_bytes_backward": "Init Bwd Win Byts",
    "act_data_pkt_fwd": "Fwd Act Data Pkts",
    "min_seg_size_forward": "Fwd Seg Size Min",
    "Active Mean": "Active Mean",
    "Idle Mean": "Idle Mean",
    "Fwd Packets/s": "Fwd Pkts/s",
    "Bwd Packets/s": "Bwd Pkts/s",
    "Fwd Packet Length Max": "Fwd Pkt Len Max",
    "Bwd Packet Length Max": "Bwd Pkt Len Max",
    "ECE Flag Count": "ECE Flag Cnt",
    "CWE Flag Count": "CWE Flag Count",
    "Shadow Node Interaction": None,
    "MTD Port Delta": None,
}
ARGUS_MAP = {
    "Distinct Dst Ports/IP": "ct_dst_sport_ltm",
    "Unique Dst IPs/Src": 0,
    "Flow Duration": "dur",
    "Total Fwd Packets": "spkts",
    "SYN Flag Count": 0,
    "RST Flag Count": 0,
    "ACK Flag Count": 0,
    "IAT Mean": "sinpkt",
    "TTL Value": "sttl",
    "TCP Window Size": "swin",
    "Total Bwd Packets": "dpkts",
    "Fwd Packet Length Mean": "smean",
    "Bwd Packet Length Mean": "dmean",
    "Flow Bytes/s": "rate",
    "Flow Packets/s": "rate",
    "Fwd IAT Mean": "sinpkt",
    "Bwd IAT Mean": "dinpkt",
    "Min Packet Length": "sbytes",
    "Max Packet Length": "sbytes",
    "Packet Length Mean": "smean",
    "Packet Length Std": 0,
    "FIN Flag Count": 0,
    "PSH Flag Count": 0,
    "URG Flag Count": 0,
    "Fwd Header Length": 0,
    "Bwd Header Length": 0,
    "Down/Up Ratio": "dinpkt",
    "Average Packet Size": "smean",
    "Avg Fwd Segment Size": "smean",
    "Avg Bwd Segment Size": "dmean",
    "Subflow Fwd Packets": "spkts",
    "Subflow Fwd Bytes": "sbytes",
    "Subflow Bwd Packets": "dpkts",
    "Subflow Bwd Bytes": "dbytes",
    "Init_Win_bytes_forward": "swin",
    "Init_Win_bytes_backward": "dwin",
    "act_data_pkt_fwd": "spkts",
    "min_seg_size_forward": "smean",
    "Active Mean": "sjit",
    "Idle Mean": "djit",
    "Fwd Packets/s": "spkts",
    "Bwd Packets/s": "dpkts",
    "Fwd Packet Length Max": "sbytes",
    "Bwd Packet Length Max": "dbytes",
    "ECE Flag Count": 0,
    "CWE Flag Count": 0,
    "Shadow Node Interaction": None,
    "MTD Port Delta": None,
}
# Names the maps use for a contract feature under a different heading.
ALIGNED_NAMES = {
    "dst_port": "Distinct Dst Ports/IP",
    "flow_iat_mean": "IAT Mean",
    "shadow_node_interaction": "Shadow Node Interaction",
    "mtd_port_delta": "MTD Port Delta",
}
