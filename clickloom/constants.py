"""Names, terms, thresholds and orders that results depend on."""

# Every action a record may carry.
ACTIONS = [
    "search", "click", "view_profile", "send_message", "save_post", "share", "comment",
    "login", "logout", "page_view", "download", "upload", "follow", "unfollow",
]

# Actions that get a column of their own in the user pivot.
PIVOT_ACTIONS = [
    "search", "click", "view_profile", "send_message", "comment", "save_post", "share",
    "follow", "login",
]

# Fixed value: action name of the per-user total row.
TOTAL_ACTION = "__total__"

# Actions whose dwell time is checked, and the thresholds in milliseconds.
DWELL_CHECKED_ACTIONS = ["click", "page_view"]
MIN_DWELL_MS = 500
DEEP_CLICK_MS = 30_000

# User-agent terms that mark a bot.
BOT_AGENT_TERMS = ["bot", "crawler", "spider", "scraper", "curl", "wget", "python-requests"]

# Search terms that count as professional.
PROFESSIONAL_TERMS = [
    "machine learning", "data engineer", "kubernetes", "spark", "hadoop", "mlops",
    "neural network", "microservice", "ci/cd", "docker", "terraform", "system design",
    "database shard", "stream processing", "recommendation",
]

# Smallest searches, messages and mean session minutes of a high-value user.
LABEL_MIN_SEARCHES = 3
LABEL_MIN_MESSAGES = 1
LABEL_MIN_MINUTES = 10

# Model inputs, in vector order.
FEATURES = [
    "n_search", "n_click", "n_view_profile", "n_send_message", "n_comment", "n_save_post",
    "n_share", "n_follow", "total_actions", "total_sessions", "avg_session_duration_min",
    "avg_events_per_session", "avg_inter_event_sec", "total_professional_searches",
    "total_deep_clicks", "professional_ratio", "click_through_rate",
]

# Names of clusters and labels in reports.
ARCHETYPES = {
    0: "Power Networkers",
    1: "Passive Browsers",
    2: "Content Creators",
    3: "Job Seekers",
    4: "Casual Observers",
}
LABEL_NAMES = {0: "low-value", 1: "high-value"}

# Prediction column of each voter and its name in the metrics report.
VOTERS = {"nb_pred": "NaiveBayes", "svm_pred": "LinearSVM", "mlp_pred": "MLP-NN"}
ENSEMBLE_COLUMN = "ensemble_prediction"
ENSEMBLE_NAME = "Ensemble-Vote"

# Training parameters.
TRAIN_FRACTION = 0.8
SEED = 42
CLUSTERS = 5

# Bounds of the point listing and of user ids in lookups.
DEFAULT_POINTS = 2_000
MAX_POINTS = 50_000
USER_ID_PATTERN = r"[A-Za-z0-9_\-]{3,64}"
