"""Column functions: native expressions only, no Python per row."""

from formspark.functions.dates import (
    file_name_month_day,
    folder_date,
    iso_date,
    strict_folder_date,
)
from formspark.functions.paths import (
    base_name,
    batch_folder,
    category_subdir,
    destination_path,
    legacy_unit_name,
    natural_key,
    norm_prefix,
    parse_uri,
    relative_folder,
    stem,
    unit_name,
)
from formspark.functions.text import (
    answer_type,
    clean,
    clean_transcribed,
    format_ok,
    full_text,
    is_choice_list,
    is_retryable,
    is_yes,
    join_choices,
    norm_text,
    page_range,
    question_number,
    question_page,
    question_rank,
    question_type,
    review_category,
    split_choices,
)
from formspark.functions.verdicts import content_verdict, language_note, language_ok

__all__ = [
    "answer_type", "base_name", "batch_folder", "category_subdir", "clean",
    "clean_transcribed", "content_verdict", "destination_path",
    "file_name_month_day", "folder_date", "format_ok", "full_text",
    "is_choice_list", "is_retryable", "is_yes", "iso_date", "join_choices",
    "language_note", "language_ok", "legacy_unit_name", "natural_key",
    "norm_prefix", "norm_text", "page_range", "parse_uri", "question_number",
    "question_page", "question_rank", "question_type", "relative_folder",
    "review_category", "split_choices", "stem", "strict_folder_date", "unit_name",
]
