from pressmill.checks import text_checks, date_checks, article_checks, run_checks, page_checks, json_checks, file_checks, language_checks, stream_checks  # noqa: F401
from pressmill.checks.registry import ORACLES, QUERIES  # noqa: F401
