"""Fixed values that results depend on.

FIXED VALUES — these must stay exactly as listed (names, addresses, tokens);
they define which events are flagged and therefore every downstream count.
"""

# Feature path: sensitive actions (19 names).
FEATURE_SENSITIVE_ACTIONS = [
    "CreateUser", "CreateAccessKey", "AttachUserPolicy", "PutUserPolicy",
    "AddUserToGroup", "CreateRole", "DeleteUser", "DeleteAccessKey",
    "StopLogging", "DeleteTrail", "UpdateTrail", "DeleteBucket",
    "CreateDBSnapshot", "CopyDBSnapshot", "ListSecrets", "GetSecretValue",
    "PutBucketPolicy", "DeleteBucketPolicy", "CreateLoginProfile",
]

# Parser path: sensitive actions (14 names; a different, shorter list).
PARSER_SENSITIVE_ACTIONS = [
    "CreateUser", "CreateAccessKey", "AttachUserPolicy", "PutUserPolicy",
    "AddUserToGroup", "CreateRole", "StopLogging", "DeleteTrail",
    "UpdateTrail", "DeleteBucket", "CreateDBSnapshot", "CopyDBSnapshot",
    "ListSecrets", "GetSecretValue",
]

# Reconnaissance actions (10 names).
RECON_ACTIONS = [
    "ListUsers", "ListRoles", "ListBuckets", "ListAccessKeys",
    "DescribeInstances", "DescribeDBInstances", "ListSecrets",
    "GetAccountSummary", "ListGroups", "ListPolicies",
]

# Data-access actions (6 names).
DATA_ACCESS_ACTIONS = [
    "GetObject", "PutObject", "DeleteObject", "CopyObject",
    "GetBucketAcl", "GetObjectAcl",
]

# Known-bad source addresses (the "threat feed"; 5 addresses).
SUSPICIOUS_IPS = [
    "45.227.255.206", "103.75.118.91", "185.220.101.34",
    "91.240.118.172", "23.94.188.246",
]

# Lower-case user-agent tokens marking tooling (11 tokens).
SUSPICIOUS_USER_AGENT_TOKENS = [
    "kali", "parrot", "pentoo", "blackarch",
    "sqlmap", "nikto", "nmap", "masscan",
    "curl", "wget", "python-requests",
]

# Event-source categories: substring (checked on the lower-cased source, in
# this order, first match wins) -> category -> code.
SERVICE_CATEGORIES = [
    ("iam", "identity", 0),
    ("s3", "storage", 1),
    ("ec2", "compute", 2),
    ("rds", "database", 3),
    ("lambda", "serverless", 4),
    ("cloudtrail", "audit", 5),
]
SERVICE_OTHER = ("other", 6)

# Time periods: [start_hour, end_hour) -> name -> code; anything else is night.
TIME_PERIODS = [
    (6, 12, "morning", 0),
    (12, 17, "afternoon", 1),
    (17, 21, "evening", 2),
]
TIME_PERIOD_OTHER = ("night", 3)

# Rule risk score weights (feature path); maximum total is 19.
RISK_WEIGHTS = [
    ("is_sensitive_action", 3),
    ("is_recon_action", 2),
    ("is_suspicious_ip", 3),
    ("is_suspicious_user_agent", 2),
    ("is_late_night", 1),
    ("is_weekend", 1),
    ("has_error", 1),
    ("is_access_denied", 2),
    ("is_burst_activity", 2),
    ("is_new_user", 1),
    ("is_rare_event", 1),
]
RISK_MAX_SCORE = 19

# Risk levels on the 0-100 normalised score (lower bounds), and their codes.
RISK_LEVELS = [(70, "critical"), (50, "high"), (25, "medium")]
RISK_LEVEL_CODES = {"low": 0, "medium": 1, "high": 2, "critical": 3}
RISK_LEVEL_ORDER = ["low", "medium", "high", "critical"]

# Parser rule levels on the small integer score (lower bounds).
PARSER_RISK_LEVELS = [(4, "critical"), (3, "high"), (1, "medium")]

# Thresholds of the count features.
NEW_USER_BELOW = 5
RARE_EVENT_BELOW = 10
BURST_ABOVE = 10
UNUSUAL_USER_HOUR_ABOVE = 20
BUSINESS_HOURS = (9, 18)
LATE_NIGHT_HOURS = (0, 5)

# ML severity bands on the 0-100 anomaly score (lower bounds).
SEVERITY_LEVELS = [(80, "critical"), (60, "high"), (40, "medium")]
SEVERITY_ORDER = ["critical", "high", "medium", "low"]

# The 34 model inputs, in model order.
ML_FEATURES = [
    "hour", "day_of_week", "is_business_hours", "is_weekend", "is_late_night",
    "time_period_encoded",
    "user_total_events", "user_unique_ips", "user_unique_event_types",
    "user_error_rate", "is_new_user", "user_activity_diversity",
    "is_sensitive_action", "is_recon_action", "is_data_access", "has_error",
    "is_access_denied", "service_category_encoded", "event_type_frequency",
    "is_rare_event",
    "is_suspicious_ip", "is_internal_ip", "ip_event_count", "ip_unique_users",
    "is_shared_ip", "is_suspicious_user_agent", "is_console_access",
    "time_since_prev_event", "is_rapid_event", "events_this_minute",
    "is_burst_activity", "user_events_this_hour", "is_unusual_user_activity",
    "risk_score_normalized",
]

# Model parameters of the detection run.
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_SEED = 42
CONTAMINATION = 0.10

# Threat rules described for the dashboard (prose-only capabilities).
PRIVILEGE_ESCALATION_ACTIONS = [
    "CreateUser", "CreateAccessKey", "AttachUserPolicy", "PutUserPolicy",
    "AddUserToGroup", "CreateRole",
]
ATTACH_POLICY = r"^Attach\w*Policy$"        # of users, groups and roles
LOG_TAMPERING_ACTIONS = ["StopLogging", "DeleteTrail", "UpdateTrail"]
