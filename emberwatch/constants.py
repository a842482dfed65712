"""Fixed values that define the results.

Everything in this module is data, not logic: class codes, labels, thresholds,
zone names and the texts shown to people. They must stay exactly as written for
results to be comparable with the dashboards and alert messages users know.
"""

# Classes.
NORMAL, FIRE_RISK, FIRE, UNKNOWN = "NORMAL", "FIRE_RISK", "FIRE", "UNKNOWN"
CLASS_LABELS = {0: NORMAL, 1: FIRE_RISK, 2: FIRE}
ABNORMAL_CODES = [1, 2]
ABNORMAL_LABELS = [FIRE, FIRE_RISK]

# Threshold rule (strictly greater than).
FIRE_TEMPERATURE, FIRE_SMOKE = 65.0, 400.0
RISK_TEMPERATURE, RISK_SMOKE = 50.0, 200.0

# Plant size, freshness and windows.
TOTAL_SENSORS = 50
STALE_SECONDS = 120
CLOCK_SKEW_SECONDS = 60
HISTORY_ROWS = 500
TREND_ROWS = 200
TREND_POINTS = 100
TRIGGER = "30 seconds"

# Feature order of every model.
FEATURES = ["temperature", "humidity", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm"]

# Zone keys and display names, in display order.
ZONES = {
    "Kho_Nguyen_Lieu": "Kho Nguyên Liệu",
    "Kho_Vat_Lieu": "Kho Vật Liệu",
    "Kho_Hoa_Chat": "Kho Hóa Chất",
    "Kho_Thanh_Pham": "Kho Thành Phẩm",
    "Kho_Linh_Kien": "Kho Linh Kiện",
    "Xuong_San_Xuat": "Xưởng Sản Xuất",
    "Khu_Dong_Goi": "Khu Đóng Gói",
    "Khu_Kiem_Tra": "Khu Kiểm Tra",
    "Phong_May": "Phòng Máy",
    "Khu_Bao_Tri": "Khu Bảo Trì",
}
ZONE_MISSING_WEB = "Chưa xác định"

# Synonyms accepted by the web status rule.
WEB_STATUS_SYNONYMS = {
    "FIRE": ["FIRE", "FIRE_DETECTED", "FIRE_ALERT", "CHAY", "CHÁY", "DANGER_FIRE", "2"],
    "RISK": ["RISK", "FIRE_RISK", "WARNING", "WARN", "DANGER", "CANH_BAO", "CẢNH_BÁO", "1"],
    "NORMAL": ["NORMAL", "SAFE", "OK", "AN_TOAN", "AN_TOÀN", "0"],
}

# Texts that count as a missing value in alerts.
MISSING_TEXTS = ["", "none", "null", "nan"]

# Display texts.
STATUS_TEXT = {
    "NORMAL": "🟢 Bình thường",
    "FIRE_RISK": "🟡 Nguy cơ cháy",
    "FIRE": "🔴 Cháy",
}
INCIDENT_TEXT = {
    "FIRE_RISK": "🟡 Nguy cơ cháy",
    "FIRE": "🔴 Báo động cháy",
}
ALERT_CARD_TEXT = {
    "FIRE": "🔴 BÁO ĐỘNG CHÁY",
    "FIRE_RISK": "🟡 NGUY CƠ CHÁY",
}
WEB_STATUS_TEXT = {
    "NORMAL": "NORMAL · An toàn",
    "RISK": "RISK · Nguy cơ",
    "FIRE": "FIRE · Phát hiện cháy",
    "UNKNOWN": "UNKNOWN · Chưa xác định",
}
FRESH_TEXT, STALE_TEXT = "🟢 Dữ liệu mới", "⚠️ Dữ liệu cũ"
CARD_FRESH_TEXT, CARD_STALE_TEXT = "DỮ LIỆU MỚI", "DỮ LIỆU CŨ — kiểm tra sensor"
NO_TIME_TEXT = "Không có thời gian"
NO_MEASURE_TEXT = "—"
NOT_AVAILABLE = "N/A"

# Column headings of the result tables.
BOARD_HEADINGS = [
    "Mã Sensor", "Khu Vực", "Thời Gian Ghi Nhận", "Độ Mới Dữ Liệu",
    "Nhiệt Độ (°C)", "Độ Ẩm (%)", "Khói (ppm)", "LPG (ppm)", "CO (ppm)",
    "Trạng Thái Hiện Tại",
]
INCIDENT_HEADINGS = [
    "ID", "Sensor", "Khu Vực", "Thời Gian Ghi Nhận",
    "Nhiệt Độ (°C)", "Khói (ppm)", "LPG (ppm)", "CO (ppm)",
    "Xác Suất Nguy Cơ (%)", "Xác Suất Cháy (%)", "Cấp Cảnh Báo",
]
EXPLORER_HEADINGS = [
    "ID", "Mã Sensor", "Khu Vực", "Thời Gian Sensor", "Thời Điểm Ghi DB", "Độ Mới Dữ Liệu",
    "Nhiệt Độ (°C)", "Độ Ẩm (%)", "Khói (ppm)", "LPG (ppm)", "CO (ppm)",
    "Trạng Thái",
]
BREAKDOWN_GROUPS = [
    ("normal", "NORMAL — An toàn"),
    ("risk", "RISK — Nguy cơ"),
    ("fire", "FIRE — Phát hiện cháy"),
    ("offline", "OFFLINE — Mất kết nối"),
    ("unknown_status", "UNKNOWN — Chưa xác định trạng thái"),
    ("missing", "Chưa xuất hiện trong dữ liệu"),
]

# Alert message texts. {n} is a count or number.
MESSAGE_LIMIT = 3500
MESSAGE_RESERVE = 60
MESSAGE_MINIMUM = 100
PART_PREFIX = "📨 CẢNH BÁO PHẦN {n}/{total}\n\n"
ALERT_TITLE = {
    "FIRE": "🚨🚨🚨 CẢNH BÁO CHÁY KHẨN CẤP 🚨🚨🚨",
    "FIRE_RISK": "⚠️⚠️⚠️ CẢNH BÁO NGUY CƠ CHÁY ⚠️⚠️⚠️",
}
ALERT_FOUND = "Phát hiện {n} sensor có trạng thái {severity}."
ALERT_ADVICE = {
    "FIRE": "Hãy kiểm tra và xử lý theo quy trình an toàn của nhà máy.",
    "FIRE_RISK": "Cần kiểm tra khu vực có dấu hiệu bất thường.",
}
ALERT_SENSOR_TITLE = {
    "FIRE": "🔴 SENSOR FIRE #",
    "FIRE_RISK": "🟡 SENSOR FIRE_RISK #",
}
ALERT_FIELDS = {
    "sensor_id": "Sensor: ",
    "zone": "Khu vực: ",
    "timestamp": "Thời gian: ",
    "temperature": "Nhiệt độ: ",
    "smoke_ppm": "Khói: ",
    "lpg_gas_ppm": "LPG: ",
    "co_gas_ppm": "CO: ",
    "status": "Trạng thái: ",
    "probability_fire": "Xác suất FIRE: ",
    "probability_risk": "Xác suất FIRE_RISK: ",
}
UNIT_TEMPERATURE, UNIT_PPM = " °C", " ppm"

# The twelve model configurations and the seed.
SEED = 42
RANDOM_FORESTS = {  # trees, depth
    "RF1": (50, 5), "RF2": (100, 8), "RF3": (150, 10), "RF4": (200, 12),
}
DECISION_TREES = {  # depth, minimum instances per node
    "DT1": (5, 10), "DT2": (8, 5), "DT3": (10, 2), "DT4": (12, 1),
}
LOGISTIC_REGRESSIONS = {  # iterations, regularisation, elastic net
    "LR1": (50, 0.1, 0.0), "LR2": (100, 0.05, 0.0), "LR3": (150, 0.01, 0.5), "LR4": (200, 0.0, 0.0),
}
