"""Fixed values.

FIXED VALUES: every constant below must equal the behaviour being matched
(severity names, band edges, weights, expected mixes, keyword lists, default
texts). They are stated plainly, in natural order, and nowhere else.
"""

# --- FIXED VALUES: severities -------------------------------------------------
SEVERITIES = ["info", "low", "medium", "high", "critical"]

# Scorecard band table (both ends inclusive).
SCORECARD_BANDS = {
    "info": (0, 20),
    "low": (20, 40),
    "medium": (40, 70),
    "high": (70, 90),
    "critical": (90, 100),
}

# Coherence band table (both ends inclusive); unknown severity -> (0, 100).
COHERENCE_BANDS = {
    "info": (0, 20),
    "low": (10, 40),
    "medium": (30, 70),
    "high": (60, 90),
    "critical": (80, 100),
}

# Scorecard realism: expected severity mix.
REALISM_EXPECTED = {"info": 0.4, "low": 0.3, "medium": 0.2, "high": 0.08, "critical": 0.02}

# Realism verifier: allowed severity share ranges (inclusive).
REALISM_RANGES = {
    "info": (0.4, 0.8),
    "low": (0.1, 0.3),
    "medium": (0.05, 0.2),
    "high": (0.01, 0.1),
    "critical": (0.0, 0.05),
}

# Correlation-quality weight per referenced severity (unknown -> 0.1).
SEVERITY_WEIGHTS = {"info": 0.1, "low": 0.3, "medium": 0.6, "high": 0.8, "critical": 1.0}
SEVERITY_WEIGHT_DEFAULT = 0.1

# Risk subscore multipliers per severity (unknown -> 0.5).
SUBSCORE_MULTIPLIERS = {"info": 0.2, "low": 0.4, "medium": 0.6, "high": 0.8, "critical": 1.0}
SUBSCORE_MULTIPLIER_DEFAULT = 0.5

# Contextual risk per severity.
CONTEXT_RISK = {"info": 15, "low": 25, "medium": 55, "high": 80, "critical": 95}

# --- FIXED VALUES: defaults for missing fields ---------------------------------
DEFAULT_TITLE = "Unknown Finding"
DEFAULT_SEVERITY = "info"
DEFAULT_RISK = 10
DEFAULT_DESCRIPTION = "No description available"
DEFAULT_CATEGORY = "unknown"
DEFAULT_SUBSCORE = 0.5
DEFAULT_STRENGTH = 0.5

# Scorecard schema stage: required keys.
SCHEMA_REQUIRED = ["id", "title", "severity", "risk_score", "description", "metadata",
                   "category", "tags", "risk_subscores"]
SCHEMA_REQUIRED_CORRELATION_EXTRA = ["correlation_refs", "correlation_type"]
# Completeness score keys.
COMPLETENESS_KEYS = ["id", "title", "severity", "risk_score", "description", "metadata"]
SCANNER_NORMALISER = 8

# Scorecard stages in order.
STAGES = ["schema_validation", "consistency_check", "realism_assessment",
          "correlation_validation", "quality_scoring"]

# Realism verifier row rules.
VALID_SOCKET_STATES = ["LISTEN", "ESTABLISHED", "SYN_SENT", "SYN_RECV", "FIN_WAIT1", "FIN_WAIT2",
                       "TIME_WAIT", "CLOSE", "CLOSE_WAIT", "LAST_ACK", "CLOSED"]
FAKE_COMMAND_MARKERS = ["/fake/", "/malware/", "/evil/"]
HOST_KEYS = ["distro", "distro_version", "package_manager", "kernel"]
REPETITION_FIELDS = ["command", "port", "protocol", "user"]

# Abundance verifier limits.
MAX_SIMILAR_FINDINGS = 50
MAX_CATEGORY_SHARE = 0.8

# Dedup pattern metadata keys, in order.
PATTERN_KEYS = ["type", "pattern", "indicator", "command", "file_path"]
DEDUP_THRESHOLD = 0.95

# --- FIXED VALUES: tags ----------------------------------------------------------
TAGS_HIGH = ["high_priority", "needs_attention"]
TAGS_MEDIUM = ["moderate_risk"]
TAGS_LOW = ["low_priority"]

# --- FIXED VALUES: generic rationale phrases (substring test) --------------------
GENERIC_RATIONALE_PHRASES = ["analysis complete", "no additional metadata provided", "n/a", "none", "unknown"]
GENERIC_RATIONALE_FALLBACK = "No detailed rationale available; generated summary follows."

# --- FIXED VALUES: placeholder words ---------------------------------------------
PLACEHOLDER_WORDS = ["unknown", "none", "null", "na", "n/a"]
