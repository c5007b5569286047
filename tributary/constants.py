"""Fixed values of the log-routing contract. They must equal the published ones for results to match."""

# Environment word in front of the first dash of a cluster id.
ENVIRONMENTS = {"prod": "production", "stg": "staging", "dev": "development"}
DEFAULT_ENVIRONMENT = "production"

# Fields a collector adds; they are left out when a record has no message of its own.
METADATA_FIELDS = (
    "cluster_id",
    "namespace",
    "application",
    "pod_name",
    "ingest_timestamp",
    "timestamp",
    "kubernetes",
)

DELIVERY_TYPES = ("cloudwatch", "s3")
DEFAULT_REGION = "us-east-1"
DEFAULT_PREFIX = "ROSA/cluster-logs/"
ROLE_ARN_PREFIX = "arn:aws:iam::"
COPY_ACL = "bucket-owner-full-control"
METRICS_NAMESPACE = "HCPLF/LogForwarding"

# Event batches: limits and the bytes counted on top of every message.
MAX_BATCH_EVENTS = 1000
MAX_BATCH_BYTES = 1_037_576
EVENT_OVERHEAD_BYTES = 26

# Queue behaviour.
MAX_RETRIES = 3
MAX_DELAY_S = 900
MAX_RECEIVE_COUNT = 3
VISIBILITY_TIMEOUT_S = 900
MESSAGE_RETENTION_S = 1_209_600

# Central objects: 64 MB or 300 s.
CENTRAL_OBJECT_BYTES = 67_108_864
CENTRAL_OBJECT_SECONDS = 300

RETENTION_DAYS = 7
ARCHIVE_DAYS = 1
DEEP_ARCHIVE_DAYS = 90
HEARTBEAT_INTERVAL_S = 120
HEARTBEAT_MAX_GAP_S = 300
PAGE_LIMIT = 50

# Epoch numbers around this value switch between seconds and milliseconds.
EPOCH_MS_BOUNDARY = 1e12

# Copy errors that no retry can repair.
PERMANENT_COPY_ERRORS = ("NoSuchBucket", "AccessDenied", "NoSuchKey")

LOG_LEVELS = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL")

# Published application groups.
APPLICATION_GROUPS = {
    "API": ("kube-apiserver", "openshift-apiserver"),
    "Authentication": ("oauth-server", "oauth-apiserver"),
    "Controller Manager": (
        "kube-controller-manager",
        "openshift-controller-manager",
        "openshift-route-controller-manager",
    ),
    "Scheduler": ("kube-scheduler",),
}
