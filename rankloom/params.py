"""Domain parameters. Every operator takes the ones it uses as keyword defaults."""

from __future__ import annotations

# --- Fixed values: they must equal the published rules for results to agree. ---

SITE = "https://github.com"
API_SITE = "https://api.github.com/repos"
RAW_SITE = "https://raw.githubusercontent.com"
BOARD_PATH = "/trending"
EMPTY_BOARD = r"(?i)we don['’]t have any trending repositories|no trending repositories found"

SCOPES = ("global", "python", "typescript", "javascript", "jupyter-notebook", "go", "rust")
PERIODS = ("daily", "weekly", "monthly")
PERIOD_DAYS = {"daily": 1, "weekly": 7, "monthly": 30}
DEFAULT_PERIOD = "weekly"

BATCH_VERSION = 4
EDITION_VERSION = 1
MANIFEST_VERSION = 1

TREND_WEIGHTS = {
    "weekly_percentile": 0.50,
    "daily_percentile": 0.20,
    "monthly_percentile": 0.15,
    "rank_momentum": 0.10,
    "cross_period": 0.05,
}
FINAL_WEIGHTS = {"trend": 0.20, "quality": 0.45, "value": 0.35}

TREND_PASS = 40.0
QUALITY_PASS = 60
VALUE_PASS = 60
FINAL_PASS = 65.0
GRADES = (("S", 85.0), ("A", 75.0), ("B", FINAL_PASS))

NEUTRAL = 50.0
MOMENTUM_SLOPE = 5.0
NEW_HOT_DAYS = 90
FEATURES_PER_PERIOD = 5
EVIDENCE_MAX_AGE_DAYS = 1

STATE_FLAGS = ("is_fork", "is_mirror", "archived")
GATES = (
    "canonical_original",
    "readme_clear",
    "substantive_artifact",
    "readme_code_consistent",
    "run_path_documented",
    "not_spam_or_coursework",
    "install_scripts_reasonable",
    "dependencies_available",
)
QUALITY_LIMITS = {
    "readme_source_consistency": 20,
    "implementation_completeness": 20,
    "install_usage_clarity": 15,
    "tests_ci_release": 20,
    "docs_examples_errors": 10,
    "architecture_maintenance": 10,
    "dependency_transparency": 5,
}
VALUE_LIMITS = {
    "problem_value": 20,
    "practical_improvement": 20,
    "use_frequency": 15,
    "workflow_completeness": 15,
    "interoperability": 10,
    "extensibility": 10,
    "compounding_value": 5,
    "cost_benefit": 5,
}
VALUE_LEVELS = ("P0", "P1", "P2", "P3", "P4")

EVIDENCE_ENDPOINTS = {"repository": "", "readme": "/readme", "license": "/license", "root_contents": "/contents"}

CARD_SCALAR_FIELDS = ("one_line", "what", "usage", "why", "value")
CARD_LIST_FIELDS = ("audience", "features", "strengths", "limitations")
MIN_ITEMS = {"features": 2, "strengths": 2}

# What is no prose in a document, and its frontmatter. These patterns define which characters the rules count.
COMMENT = r"(?s)<!--.*?-->"
FENCED = r"(?s)```.*?```"
INLINE_CODE = r"`[^`]+`"
DATA_URI = r"data:[^\s)\"']+"
WEB_URL = r"https?://\S+"
QUOTED_LINE = r"(?m)^[ \t]*[|>].*$"
FRONTMATTER = r"(?s)\A---\n(.*?)\n---\n"

# Character class (regex body) of the language texts are localized into.
NATIVE_SCRIPT = "一-鿿"
# Characters that may continue a run of foreign prose after its first letter.
FOREIGN_RUN = "A-Za-z0-9 ,.'’\\-–—/:()"
CARD_FOREIGN_RUN_MIN = 60
DOCUMENT_FOREIGN_RUN_MIN = 160
NATIVE_CHARS_MIN = 80
LENGTH_RATIO_MIN = 0.25

FRONTMATTER_KEYS = ("full_name", "source_url", "source_sha256", "language", "mode")
LOCAL_LANGUAGE = "zh-CN"
MODE_COPY = "source-copy"
MODE_TRANSLATION = "faithful-translation"
PLACEHOLDERS = ("待翻译", "TODO_TRANSLATE")
MEDIA_TAGS = ("picture", "img", "video", "details", "table")
LOCAL_SECTION_ID = "chinese-readme"

# Elements whose tag begins a block of raw HTML in Markdown, by its specification.
HTML_BLOCK_TAGS = (
    "address", "article", "aside", "base", "basefont", "blockquote", "body", "caption", "center", "col", "colgroup", "dd",
    "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frame", "frameset",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "iframe", "legend", "li", "link", "main", "menu",
    "menuitem", "nav", "noframes", "ol", "optgroup", "option", "p", "param", "search", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "title", "tr", "track", "ul",
)

LABEL_UNCATEGORIZED = "未分类"
LABEL_NO_LANGUAGE = "未标注"
LABEL_NOT_SHOWN = "未展示"

REQUIRED_CARD_HEADINGS = (
    "## 一句话介绍",
    "## 项目是做什么的",
    "## 适合谁",
    "## 使用方式",
    "## 主要功能",
    "## 为什么值得关注",
    "## 主要优点",
    "## 明确不足",
    "## License作用域",
    "## 项目价值判断",
    "## Trending表现与综合评分",
    "## 项目链接",
)
FORBIDDEN_CARD_HEADINGS = (
    "## 数据与状态如何保存",
    "## 模型和供应商如何接入",
    "## 错误、重试与恢复",
    "## 安装与依赖成本",
    "## 测试、CI与Release",
    "## License双轨",
    "## 与同类项目的区别",
    "## 核心调用链",
    "## 核心源码证据",
)
REQUIRED_REPORT_SECTIONS = ("日榜精选", "周榜精选", "月榜精选")
FORBIDDEN_REPORT_PHRASES = (
    "淘汰项目与原因",
    "数据缺口",
    "判断边界",
    "今日一句话结论",
    "AI主题候选",
    "NEW_HOT｜近期新项目",
    "REVIVED_HOT｜重新走红项目",
)
FORBIDDEN_PHRASES = {
    "features": (
        "提供与项目主张相对应的开源内容和使用文档",
        "包含明确的依赖或构建清单",
        "包含可定位的入口或核心实现文件",
        "仓库包含测试或CI相关内容",
        "README与当前根目录代码树可相互定位",
        "存在可定位的入口、源码目录或核心实现",
        "仓库包含测试或持续集成相关证据",
    ),
    "strengths": (
        "当前进入GitHub Trending候选池",
        "README提供了较清楚的使用路径",
        "README提供安装、运行或使用路径",
        "存在测试或持续集成证据",
        "测试或CI证据可定位",
    ),
}
FORBIDDEN_PATTERNS = {
    "one_line": (r"是一个.+项目[，,:].*主要使用.+实现",),
    "what": (r"项目围绕[“\"].+[”\"].*(?:提供|包含).*(?:实现|文档|工作流)",),
    "audience": (r"^需要相关开源(?:方案|工具)的开发者$", r"^评估技术(?:选型与工作流|方案)的团队$"),
    "usage": (r"^(?:按照|先阅读)\s*README",),
    "why": (r"^项目出现在.+(?:Stars|星标).+[。.]?$",),
    "limitations": (r"^本知识库只做静态核验",),
    "value": (r"^属于(?:可持续使用的生产型系统|较完整的工具或工作流|可复用的基础设施或生态型能力)",),
}

# --- End of the fixed values. ---
