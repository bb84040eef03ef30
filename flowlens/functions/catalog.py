"""Column names the engine knows about."""

# Flow columns and the features derived from them, by family.
NUMERIC_COLUMNS = ["Dur", "sTos", "dTos", "TotPkts", "TotBytes", "SrcBytes", "DstBytes"]
PORT_COLUMNS = ["Sport", "Dport"]
BASE_FEATURES = ["Dur", "TotBytes", "TotPkts", "SrcBytes"]
ROW_FEATURES = [
    "DstBytes", "flow_ratio", "bytes_symmetry", "is_scanning", "src_ratio",
    "dst_ratio", "packet_size", "bytes_per_second", "packets_per_second",
]
CALENDAR_FEATURES = [
    "hour", "day_of_week", "day_of_month", "is_weekend", "is_work_hour", "is_night",
    "sin_hour", "cos_hour", "sin_day_of_week", "cos_day_of_week",
    "sin_day_of_month", "cos_day_of_month",
]
INTERVAL_FEATURES = ["time_since_last_flow", "time_to_next_flow"]
SRC_WINDOW_FEATURES = [
    "flows_per_minute_by_src", "unique_dst_per_minute_by_src",
    "unique_dport_per_minute_by_src", "total_bytes_per_minute_by_src",
]
PAIR_FEATURES = [
    "bidirectional_flow_count", "bidirectional_total_bytes",
    "bidirectional_total_packets", "bidirectional_total_src_bytes",
    "bidirectional_total_dst_bytes", "bidirectional_symmetry",
    "bidirectional_avg_bytes_per_flow", "bidirectional_avg_packets_per_flow",
    "bidirectional_avg_duration", "bidirectional_window_flow_ratio",
]
SKEWED_FEATURES = [
    "Dur", "TotBytes", "TotPkts", "SrcBytes", "DstBytes", "flow_ratio",
    "bytes_symmetry", "bytes_per_second", "packets_per_second",
    "time_since_last_flow", "time_to_next_flow", "flows_per_minute_by_src",
    "total_bytes_per_minute_by_src",
]
BEHAVIORAL_FEATURES = [
    "TotBytes", "TotPkts", "SrcBytes", "DstBytes", "Dur", "flow_ratio",
    "bytes_symmetry", "packet_size", "bytes_per_second", "packets_per_second",
    "unique_dst_per_minute_by_src", "unique_dport_per_minute_by_src",
    "flows_per_minute_by_src", "total_bytes_per_minute_by_src",
]
NON_FEATURES = [
    "Label", "label_binary", "StartTime", "SrcAddr", "DstAddr", "Sport", "Dport",
    "State", "Proto",
]
SCAN_STATES = ["RST", "REQ", "S_", "INT", "URP"]
SERVICE_PORTS = {
    53: "DNS", 123: "NTP", 67: "DHCP", 68: "DHCP", 161: "SNMP", 5353: "mDNS",
    80: "HTTP", 443: "HTTPS", 22: "SSH", 25: "SMTP",
}

# (family, stage, names); a stage includes all lower ones.
FAMILIES = [
    ("row", 0, ROW_FEATURES),
    ("calendar", 1, CALENDAR_FEATURES),
    ("interval", 2, INTERVAL_FEATURES),
    ("src_window", 3, SRC_WINDOW_FEATURES),
    ("pair_window", 4, PAIR_FEATURES),
]


def feature_names(stage: int = 4, include_time: bool = True) -> list[str]:
    """Engineered feature names up to a stage (row features are stage 0)."""
    top = stage if include_time else 0
    return [n for _, level, names in FAMILIES if level <= top for n in names]


def transformed_names(names, skewed=None, prefix: str = "log_", replace: bool = False) -> list[str]:
    """Names the given features carry after the log transform."""
    skewed = set(SKEWED_FEATURES if skewed is None else skewed)
    return [prefix + n if n in skewed and not replace else n for n in names]
