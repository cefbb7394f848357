"""Word lists, name lists and thresholds the results depend on."""

# Phrases counted by fraud_keyword_count (matched lower-cased).
FRAUD_PHRASES = (
    "trúng thưởng", "xác nhận", "tài khoản bị khóa", "khóa tài khoản", "click",
    "urgent", "free", "hoàn tiền", "nhận quà", "cập nhật thông tin",
    "xử lý ngay", "đăng nhập ngay", "chuyển tiền", "OTP", "mã xác thực",
)

# Words that make bank_mention true.
BANK_WORDS = (
    "vietcombank", "bidv", "vietinbank", "agribank", "mbbank", "mb bank",
    "techcombank", "acb", "sacombank", "shb", "tpbank", "vpbank", "ncb",
    "eximbank", "bank",
)

# Stop words removed from the token list.
STOP_WORDS = (
    "và", "là", "của", "cho", "theo", "với", "một", "các", "những", "được",
    "đang", "này", "đó", "trong", "khi", "đến", "từ", "về", "tại", "nên",
    "nếu", "thì", "có", "không",
)

# Urgent words, kept even if listed as stop words.
URGENT_WORDS = ("ngay", "liền", "khẩn", "khẩn cấp", "gấp", "sớm")

# Shortening hosts masked as [SHORTURL].
SHORT_HOSTS = ("bit.ly", "tinyurl.com", "t.co", "goo.gl", "shorturl.at", "s.id")

# Units that turn a number into an amount.
MONEY_UNITS = ("vnđ", "vnd", "đ", "dollar", "usd", "triệu", "nghìn", "k", "m")

# The manual features, in vector order.
MANUAL_FEATURES = (
    "has_url", "has_shorturl", "has_phone", "has_money", "has_bank_account",
    "bank_mention", "fraud_keyword_count", "exclamation_count",
    "capslock_ratio", "msg_length",
)

# Flags that become transaction items when they are true.
FLAG_ITEMS = ("has_url", "has_shorturl", "has_phone", "has_money", "bank_mention")

# Label spellings and their class.
LABEL_CLASSES = {
    "spam": 1, "fraud": 1, "scam": 1, "phishing": 1, "lừa đảo": 1, "1": 1,
    "ham": 0, "legit": 0, "safe": 0, "hợp lệ": 0, "0": 0,
}

# Candidate column names per source, tried in this order.
SMS_TEXT_COLUMNS = ("v2", "text", "message", "sms")
SMS_LABEL_COLUMNS = ("v1", "label", "class", "target")
EMAIL_TEXT_COLUMNS = ("text_combined", "text", "body", "message")
EMAIL_LABEL_COLUMNS = ("label", "type", "class", "target")

# CSV cells read as missing.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Severity bands, highest first.
SEVERITY_BANDS = ((0.8, "critical"), (0.6, "high"), (0.4, "medium"))
LOWEST_SEVERITY = "low"

# Weights of probability, cluster risk and rule hits.
RISK_WEIGHTS = (0.6, 0.2, 0.2)
RULE_HIT_CAP = 5

# Fixed value: scale applied to min-max scaled manual features.
MANUAL_SCALE = 0.1

# Vectoriser, mining, clustering and sampling settings.
VOCABULARY_SIZE = 5000
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT, MAX_ITEMSET = 0.15, 0.8, 1.5, 3
N_CLUSTERS, N_RESTARTS = 5, 10
TEST_SHARE = 0.2
SEED = 42
TOP_KEYWORDS, EXAMPLES_PER_CLUSTER = 7, 3
CLUSTER_NAME = "Nhóm liên quan tới '%s'"

# Report headings.
CLUSTER_TABLE_COLUMNS = (
    "Cụm", "Tên gợi ý", "Số mẫu", "Từ khóa đặc trưng", "Ví dụ 1", "Ví dụ 2", "Ví dụ 3",
)
QUALITY_TABLE_COLUMNS = ("Chỉ số", "Giá trị đạt được", "Ý nghĩa")
QUALITY_ROWS = {
    "silhouette": ("Silhouette Score", "Càng gần 1 càng tốt"),
    "davies_bouldin": ("Davies-Bouldin Index", "Càng nhỏ càng tốt"),
    "calinski_harabasz": ("Calinski-Harabasz Index", "Càng lớn càng tốt"),
    "inertia": ("Inertia (WCSS)", "Tổng phương sai nội cụm"),
}
