"""Column lists, types, rules and labels. No logic lives here.

Everything in this file is a fixed value: the names, types, ranges and labels
must stay as they are for results to be comparable.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The enrolment fact, one row per (student_id, course_id), in layer order.
# ---------------------------------------------------------------------------
ENROLMENT_COLUMNS: list[tuple[str, str]] = [
    ("student_id", "string"),
    ("gender", "string"),
    ("age", "int"),
    ("education_level", "string"),
    ("employment_status", "string"),
    ("city", "string"),
    ("device_type", "string"),
    ("internet_connection_quality", "string"),
    ("course_id", "string"),
    ("course_name", "string"),
    ("category", "string"),
    ("course_level", "string"),
    ("course_duration_days", "int"),
    ("instructor_rating", "double"),
    ("login_frequency", "int"),
    ("average_session_duration_min", "double"),
    ("video_completion_rate", "double"),
    ("discussion_participation", "int"),
    ("time_spent_hours", "double"),
    ("days_since_last_login", "int"),
    ("notifications_checked", "int"),
    ("peer_interaction_score", "double"),
    ("assignments_submitted", "int"),
    ("assignments_missed", "int"),
    ("quiz_attempts", "int"),
    ("quiz_score_avg", "double"),
    ("project_grade", "double"),
    ("progress_percentage", "double"),
    ("rewatch_count", "int"),
    ("enrollment_date", "date"),
    ("payment_mode", "string"),
    ("fee_paid", "int"),
    ("discount_used", "int"),
    ("payment_amount", "double"),
    ("app_usage_percentage", "double"),
    ("reminder_emails_clicked", "int"),
    ("support_tickets_raised", "int"),
    ("satisfaction_rating", "double"),
    ("completed", "int"),
    ("assignment_submission_rate", "double"),
]
ENROLMENT_NAMES = [name for name, _ in ENROLMENT_COLUMNS]
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}
ENROLMENT_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES[kind]) for name, kind in ENROLMENT_COLUMNS]
)
ODS_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ENROLMENT_NAMES]
)
KEY = ["student_id", "course_id"]

STUDENT_ATTRIBUTES = [
    "gender",
    "age",
    "education_level",
    "employment_status",
    "city",
    "device_type",
    "internet_connection_quality",
]
COURSE_ATTRIBUTES = [
    "course_name",
    "category",
    "course_level",
    "course_duration_days",
    "instructor_rating",
]

# ---------------------------------------------------------------------------
# Raw file: same names in Title_Case, one personal column more.
# ---------------------------------------------------------------------------
RAW_REQUIRED = ["Student_ID", "Course_ID", "Course_Name", "Completed"]
RAW_PERSONAL = ["Name"]
RAW_TEXT = [
    "Student_ID",
    "Name",
    "Gender",
    "Education_Level",
    "Employment_Status",
    "City",
    "Device_Type",
    "Internet_Connection_Quality",
    "Course_ID",
    "Course_Name",
    "Category",
    "Course_Level",
    "Payment_Mode",
]
RAW_CATEGORY = [
    "Education_Level",
    "Employment_Status",
    "City",
    "Device_Type",
    "Internet_Connection_Quality",
    "Course_Name",
    "Category",
    "Course_Level",
    "Payment_Mode",
]
RAW_INTEGER = [
    "Age",
    "Course_Duration_Days",
    "Login_Frequency",
    "Discussion_Participation",
    "Days_Since_Last_Login",
    "Notifications_Checked",
    "Assignments_Submitted",
    "Assignments_Missed",
    "Quiz_Attempts",
    "Rewatch_Count",
    "Reminder_Emails_Clicked",
    "Support_Tickets_Raised",
]
RAW_FLOAT = [
    "Instructor_Rating",
    "Average_Session_Duration_Min",
    "Time_Spent_Hours",
    "Peer_Interaction_Score",
    "Quiz_Score_Avg",
    "Project_Grade",
    "Payment_Amount",
    "Satisfaction_Rating",
]
RAW_PERCENT = [
    "Video_Completion_Rate",
    "Progress_Percentage",
    "App_Usage_Percentage",
]
RAW_FLAG = ["Fee_Paid", "Discount_Used", "Completed"]
RAW_DATE = ["Enrollment_Date"]
RAW_TARGET = "Completed"

# Inclusive bounds.
RAW_RANGES: dict[str, tuple[float, float]] = {
    "Age": (10, 100),
    "Course_Duration_Days": (1, 3650),
    "Instructor_Rating": (0, 5),
    "Average_Session_Duration_Min": (0, 1440),
    "Video_Completion_Rate": (0, 100),
    "Time_Spent_Hours": (0, 10000),
    "Peer_Interaction_Score": (0, 100),
    "Quiz_Score_Avg": (0, 100),
    "Project_Grade": (0, 100),
    "Progress_Percentage": (0, 100),
    "App_Usage_Percentage": (0, 100),
    "Satisfaction_Rating": (0, 5),
    "Completed": (0, 1),
    "Fee_Paid": (0, 1),
    "Discount_Used": (0, 1),
}

UNKNOWN = "Unknown"
NULL_TOKENS = ["", "nan", "None", "null", "NULL"]
# The tokens a pandas CSV read turns into a missing value by default.
CSV_NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
GENDER_SPELLINGS = {
    "male": "Male",
    "m": "Male",
    "男": "Male",
    "female": "Female",
    "f": "Female",
    "女": "Female",
    "other": "Other",
    "其他": "Other",
}
FLAG_SPELLINGS = {
    "yes": 1,
    "y": 1,
    "true": 1,
    "1": 1,
    "completed": 1,
    "complete": 1,
    "是": 1,
    "已完成": 1,
    "no": 0,
    "n": 0,
    "false": 0,
    "0": 0,
    "not completed": 0,
    "incomplete": 0,
    "dropout": 0,
    "否": 0,
    "未完成": 0,
}
CLEANING_METRICS = [
    "原始行数",
    "原始列数",
    "删除的关键字段缺失行数",
    "删除的重复行数",
    "删除的异常行数",
    "清洗后行数",
    "清洗后列数",
]

# ---------------------------------------------------------------------------
# Served tables: column, type. Decimal measures default to 0.
# ---------------------------------------------------------------------------
TARGETS: dict[str, list[tuple[str, str]]] = {
    "student_info": [
        ("student_id", "string"),
        ("student_name", "string"),
        ("gender", "string"),
        ("age", "int"),
        ("education_level", "string"),
        ("employment_status", "string"),
        ("city", "string"),
        ("device_type", "string"),
        ("internet_connection_quality", "string"),
        ("create_time", "timestamp"),
        ("update_time", "timestamp"),
    ],
    "course_info": [
        ("course_id", "string"),
        ("course_name", "string"),
        ("category", "string"),
        ("course_level", "string"),
        ("course_duration_days", "int"),
        ("instructor_rating", "decimal(4,2)"),
        ("create_time", "timestamp"),
        ("update_time", "timestamp"),
    ],
    "student_stat": [
        ("student_id", "string"),
        ("course_id", "string"),
        ("total_study_time_hours", "decimal(12,2)"),
        ("avg_session_duration_min", "decimal(10,2)"),
        ("course_progress_rate", "decimal(5,2)"),
        ("course_completed", "tinyint"),
        ("assignment_submit_rate", "decimal(5,2)"),
        ("quiz_score_avg", "decimal(5,2)"),
        ("project_grade", "decimal(5,2)"),
        ("login_frequency", "int"),
        ("video_completion_rate", "decimal(5,2)"),
        ("discussion_participation", "int"),
        ("peer_interaction_score", "decimal(5,2)"),
        ("days_since_last_login", "int"),
        ("app_usage_percentage", "decimal(5,2)"),
        ("satisfaction_rating", "decimal(4,2)"),
        ("update_date", "date"),
        ("create_time", "timestamp"),
        ("update_time", "timestamp"),
    ],
    "course_stat": [
        ("course_id", "string"),
        ("course_name", "string"),
        ("category", "string"),
        ("course_level", "string"),
        ("course_duration_days", "int"),
        ("learner_count", "bigint"),
        ("completion_count", "bigint"),
        ("completion_rate", "decimal(5,2)"),
        ("avg_study_time_hours", "decimal(12,2)"),
        ("avg_progress_percentage", "decimal(5,2)"),
        ("avg_video_completion_rate", "decimal(5,2)"),
        ("avg_assignment_submit_rate", "decimal(5,2)"),
        ("avg_quiz_score", "decimal(5,2)"),
        ("avg_project_grade", "decimal(5,2)"),
        ("avg_instructor_rating", "decimal(4,2)"),
        ("avg_satisfaction_rating", "decimal(4,2)"),
        ("avg_app_usage_percentage", "decimal(5,2)"),
        ("update_date", "date"),
        ("create_time", "timestamp"),
        ("update_time", "timestamp"),
    ],
    "student_feature": [
        ("student_id", "string"),
        ("course_count", "bigint"),
        ("completed_course_count", "bigint"),
        ("completion_rate", "decimal(5,2)"),
        ("total_study_time_hours", "decimal(12,2)"),
        ("avg_session_duration_min", "decimal(10,2)"),
        ("avg_login_frequency", "decimal(10,2)"),
        ("avg_video_completion_rate", "decimal(5,2)"),
        ("avg_progress_percentage", "decimal(5,2)"),
        ("avg_assignment_submit_rate", "decimal(5,2)"),
        ("avg_quiz_score", "decimal(5,2)"),
        ("avg_project_grade", "decimal(5,2)"),
        ("avg_discussion_participation", "decimal(10,2)"),
        ("avg_peer_interaction_score", "decimal(5,2)"),
        ("avg_app_usage_percentage", "decimal(5,2)"),
        ("avg_satisfaction_rating", "decimal(4,2)"),
        ("avg_days_since_last_login", "decimal(10,2)"),
        ("total_assignments_missed", "bigint"),
        ("update_date", "date"),
        ("update_time", "timestamp"),
    ],
}
TARGET_KEYS: dict[str, list[str]] = {
    "student_info": ["student_id"],
    "course_info": ["course_id"],
    "student_stat": ["student_id", "course_id"],
    "course_stat": ["course_id"],
    "student_feature": ["student_id"],
}
# Served columns that must not be null; every other measure has a default.
TARGET_NOT_NULL: dict[str, list[str]] = {
    "student_info": ["student_id"],
    "course_info": ["course_id", "course_name"],
    "student_stat": ["student_id", "course_id"],
    "course_stat": ["course_id"],
    "student_feature": ["student_id"],
}
# Numeric columns without a default of 0 in the served tables.
TARGET_NULLABLE: dict[str, list[str]] = {
    "student_info": ["age"],
    "course_info": ["course_duration_days", "instructor_rating"],
    "student_stat": [],
    "course_stat": ["course_duration_days"],
    "student_feature": [],
}

# ---------------------------------------------------------------------------
# Labels and thresholds of the risk, benchmark and profile rules.
# ---------------------------------------------------------------------------
HIGH, MID, LOW, SAFE = "高风险", "中风险", "低风险", "安全"
HIGH_MARK, MID_MARK = "高", "中"
RULE_LABELS = {
    "login": ("登录风险", "登录正常"),
    "assignment": ("作业风险", "作业正常"),
    "progress": ("进度风险", "进度正常"),
    "score": ("成绩风险", "成绩正常"),
}
RULE_TITLES = {
    "login": "登录",
    "assignment": "作业",
    "progress": "进度",
    "score": "成绩",
}
RULE_WORDS = ("风险", "正常")
UNCATEGORISED = "未分类"

# measure -> label, in the order that breaks ties
STUDENT_MEASURES = {
    "time": "学习时长",
    "completion": "课程进度",
    "video": "视频完课率",
    "grade": "作业提交率",
    "score": "测验平均分",
}
STABLE_MEASURE = "学习状态"
WEAK_RATIO = 0.92
# measure -> (factor, decimals, upper bound)
STRONG_PEER = {
    "time": (1.28, 2, None),
    "completion": (1.14, 1, 100.0),
    "video": (1.16, 1, 100.0),
    "grade": (1.12, 1, 100.0),
    "score": (1.10, 1, 100.0),
}
PERSONA_LEAD = {"completion": 1.08, "score": 1.05, "time": 1.05}
PERSONA_LABELS = {
    "leader": "自律学霸",
    "advancing": "稳定进阶",
    "at_risk": "风险预警型",
    "wavering": "波动跟进型",
    "steady": "稳步提升型",
}
COURSE_WEAK_ITEMS = {
    "avg_quiz_score": "平均得分",
    "avg_submit_rate": "作业提交",
    "avg_progress": "课程进度",
    "avg_video_completion_rate": "视频完课",
}
COURSE_WEAK_SEPARATOR = "、"
COURSE_TYPES = ("标杆引领型", "稳健深耕型", "潜力成长型")
