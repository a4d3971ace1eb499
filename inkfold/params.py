"""Parameters of the rules: thresholds, word lists, site markers and report texts.

Everything an operator compares with or prints is a field here, so a caller can
run the same plan over another site or language.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SiteParams:
    """What depends on the crawled site. Set these to your site's own values."""

    base_url: str = "https://site.example"
    # An article's page is <base>/<digits>/<digits>; None derives it from base_url.
    article_url_pattern: str | None = None
    article_id_pattern: str = r"/[0-9]+/([0-9]+)$"
    # The site name that ends a page title, and the suffix that follows an author's
    # name in it. None: the site adds none.
    title_marker: str | None = None
    name_suffix: str | None = None

    # --- fixed values ---
    comment_marker: str = "#comment"
    reply_prefix: str = "回复@"
    repost_marker: str = "原文"
    blocked_title_marker: str = "Verification"
    blocked_page_marker: str = "验证"
    placeholder_name: str = "待确认"
    likes_pattern: str = r'"likeCount":(\d+)'
    comments_pattern: str = r'"commentCount":(\d+)'
    body_selector: str = ".article__bd__detail"
    body_fallback_selectors: tuple[str, ...] = (
        ".status-content", ".article-content", ".status__content", "article",
    )
    author_selector: str = (
        '.article__bd__from a, .user-name, .author-name, .status-content a[href*="/u/"]'
    )
    time_selector: str = ".article__bd__from .date, .time, .date, .status-content .time"
    name_selector: str = ".user-name, .username, .profile__name"
    item_selector: str = ".timeline__item"
    item_title_selector: str = ".article__title, .title, h3, h4"
    item_content_selector: str = ".content, .status-content, article"
    item_time_selector: str = ".time, .date"
    item_likes_selector: str = '.like, [class*="like"]'

    @property
    def url_pattern(self) -> str:
        if self.article_url_pattern is not None:
            return self.article_url_pattern
        return "^" + self.base_url.replace(".", r"\.") + r"/[0-9]+/[0-9]+$"


@dataclass(frozen=True)
class CrawlParams:
    """Sizes of the incremental collection. Fixed values."""

    snapshot_files: int = 7
    articles_per_user: int = 20
    snapshot_title_chars: int = 50


@dataclass(frozen=True)
class GateParams:
    """Quality gate. Fixed values."""

    min_title: int = 3
    min_content: int = 200
    log_title_chars: int = 50
    summary_rows: int = 10
    short_title: str = "标题过短"
    short_content: tuple[str, str] = ("内容过短(", "字)")
    empty_title: str = "标题为空或过短"
    empty_content: tuple[str, str] = ("正文为空或过短(", "字符)")
    empty_author: str = "作者为空"
    empty_publish_time: str = "发布时间为空"


@dataclass(frozen=True)
class PriorityParams:
    """Reading priority by length and keywords. Fixed values."""

    must_read_over: int = 3000
    worth_reading_over: int = 1000
    keyword_over: int = 500
    keywords: tuple[str, ...] = (
        "估值", "分析", "研究", "财报", "商业模式", "护城河", "安全边际",
    )


@dataclass(frozen=True)
class CategoryParams:
    """Ordered topic lists; the first list with a hit names the topic. Fixed values."""

    rules: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("公司研究", ("估值", "PE", "PB", "ROE", "净利润", "现金流")),
        ("行业分析", ("行业", "赛道", "竞争", "格局")),
        ("投资理念", ("巴菲特", "价值投资", "安全边际", "护城河")),
    )
    other: str = "其他"


@dataclass(frozen=True)
class EntityParams:
    """Entity mentions in a text. Fixed values."""

    pattern: str = r"\$([A-Z]+)"
    at_most: int | None = 5


@dataclass(frozen=True)
class RuleTextsV1:
    """Texts of a rule-based analysis (first form). Fixed values."""

    issue: str = "未配置 API Key"
    core_point: str = "需配置 API Key 进行完整分析"
    pending: str = "待分析"
    assessment: str = "请配置 BAILIAN_API_KEY 环境变量"
    insight: str = "配置 API Key 后可获取完整分析"
    summary_chars: int = 30


@dataclass(frozen=True)
class RuleTextsV2:
    """Texts of a rule-based analysis (second form). Fixed values."""

    importance: str = "medium"
    content_type: str = "其他"
    no_thesis: str = "待分析"
    thesis_chars: int = 30
    implications: str = "需要配置 API Key 进行完整分析"
    action: str = "需要关注"
    confidence: str = "low"


@dataclass(frozen=True)
class ResponseParams:
    """Prompt cuts and the results of unreadable responses. Fixed values."""

    prompt_chars_v1: int = 4000
    prompt_chars_v2: int = 3000
    fallback_chars: int = 50
    fenced_pattern: str = r"(?s)```json\s*(\{.*?\})\s*```"
    greedy_pattern: str = r"(?s)(\{.*\})"
    failed: str = "解析失败"
    failed_point: str = "解析失败，请查看原文"
    unsure: str = "不确定"
    other: str = "其他"
    call_failed: str = "分析失败: "
    no_title: str = "无标题"
    no_author: str = "未知"


# Prompt templates are data; {title}, {author}, {word_count} and {content} are filled in.
PROMPT_V1 = (
    "标题：{title}\n作者：{author}\n字数：{word_count}\n\n{content}\n\n"
    "请阅读以上文章，只返回一个 JSON 对象，字段为 category、related_stocks、core_points、"
    "value_investment（alignment、margin_of_safety、analysis）、insights、summary。"
)
PROMPT_V2 = (
    "标题：{title}\n\n{content}\n\n"
    "请阅读以上文章，只返回一个 JSON 对象，字段为 importance、content_type、related_stocks、"
    "related_industries、core_thesis、key_data、investment_implications、action_required、"
    "confidence。"
)


@dataclass(frozen=True)
class DailyReportParams:
    """Cuts and line formats of the daily report. Fixed values."""

    limit: int = 20
    links_per_entity: int = 3
    link_title_chars: int = 15
    hot_entities: int = 5
    points_shown: int = 5
    article_url: str = "{base}/{user_id}/{article_id}"
    no_title: str = "无标题"
    no_author: str = "未知"
    other: str = "其他"
    unsure: str = "不确定"
    none: str = "无"
    head: tuple[str, ...] = (
        "# 📊 价值投资日报", "", "**日期**：{date}", "", "---", "",
        "## 一、概览", "",
        "- **今日新增**：{total} 篇",
        "- **有效分析**：{passed} 篇（内容 > 200 字）",
        "- **无效文章**：{failed} 篇（短状态/评论）",
        "", "---", "",
        "## 二、优先级分类", "",
        "| 优先级 | 数量 | 说明 |",
        "|--------|------|------|",
        "| 🔴 必读 | {must_read} | 高质量长文，深度分析 |",
        "| 🟡 值得关注 | {worth_reading} | 有价值的观点和分析 |",
        "| 🔵 参考 | {reference} | 短状态、预告类 |",
        "", "---", "",
        "## 三、文章集合", "",
    )
    section_titles: tuple[tuple[str, str], ...] = (
        ("must_read", "### 🔴 必读文章"),
        ("worth_reading", "### 🟡 值得关注"),
        ("reference", "### 🔵 参考文章"),
    )
    entity_head: tuple[str, ...] = (
        "---", "", "## 四、相关股票汇总", "",
        "| 股票 | 出现次数 | 相关文章 |",
        "|------|----------|----------|",
    )
    tail: tuple[str, ...] = (
        "", "---", "", "## 五、今日总结", "",
        "- **主要话题**：{topics}",
        "- **热门股票**：{hot}",
        "", "---", "",
        "*报告生成时间：{generated_at}*",
        "*分析模型：{model}*",
    )
    model: str = "智谱 GLM-5"
    analysis_title: str = "**GLM-5 分析：**"


@dataclass(frozen=True)
class InvestmentReportParams:
    """Cuts and line formats of the investment report. Fixed values."""

    list_title_chars: int = 50
    medium_title_chars: int = 40
    medium_thesis_chars: int = 60
    medium_implication_chars: int = 80
    low_title_chars: int = 30
    action_title_chars: int = 30
    titles_per_action: int = 5
    no_title: str = "无标题"
    none: str = "无"
    default_action: str = "关注"
    no_action: str = "无需行动"
    head: tuple[str, ...] = (
        "# 📊 价值投资日报 - {date}", "", "## 📰 今日新增文章", "",
        "共爬取 **{total}** 篇新文章。", "", "### 文章列表", "",
    )
    entities_title: str = "### 关联股票"
    high_title: str = "## 🔴 高优先级（值得深入研究）"
    medium_title: str = "## 🟡 中优先级（值得关注）"
    low_title: str = "## ⚪ 低优先级（信息性内容）"
    actions_title: str = "## ✅ 行动清单"
    tail: tuple[str, ...] = (
        "---", "", "*报告生成时间：{generated_at}*", "*分析模型：{model}*",
    )
    model: str = "GLM-5 (qwen-plus)"


@dataclass(frozen=True)
class Params:
    """All parameters of a run."""

    site: SiteParams = field(default_factory=SiteParams)
    crawl: CrawlParams = field(default_factory=CrawlParams)
    gate: GateParams = field(default_factory=GateParams)
    priority: PriorityParams = field(default_factory=PriorityParams)
    category: CategoryParams = field(default_factory=CategoryParams)
    entity: EntityParams = field(default_factory=EntityParams)
    responses: ResponseParams = field(default_factory=ResponseParams)
    daily: DailyReportParams = field(default_factory=DailyReportParams)
    investment: InvestmentReportParams = field(default_factory=InvestmentReportParams)
