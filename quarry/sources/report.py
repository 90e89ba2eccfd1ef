"""The four report tables (overall, per topic, publications, monthly), each written to
its own sub-folder.  Nothing is written when there are no posts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.operators import mentions as mx
from quarry.session import written

# --- fixed values: sheet names and display headers of the report --------------------------------
SHEET_OVERALL = "Общая статистика"
SHEET_TOPICS = "Статистика по университетам"
SHEET_PUBLICATIONS = "Публикации"
SHEET_MONTHLY = "Статистика по месяцам"
TOPIC_HEADERS = ["Университет", "Количество публикаций", "Количество авторов", "Всего лайков",
                 "Всего просмотров", "Всего репостов", "Всего комментариев"]
PUBLICATION_HEADERS = ["Университет", "Дата публикации", "Текст публикации", "Лайки", "Просмотры",
                       "Репосты", "Комментарии", "Ссылка на публикацию"]
MONTHLY_TOPIC_HEADER = "Университет"
# -------------------------------------------------------------------------------------------------

SHEET_DIRS = {SHEET_OVERALL: "overall", SHEET_TOPICS: "topics",
              SHEET_PUBLICATIONS: "publications", SHEET_MONTHLY: "monthly"}


def report_tables(posts: DataFrame, year: int, state: DataFrame | None = None) -> dict[str, DataFrame]:
    """P8 / P7 renamings applied to A9, A8, the publications and A11.  The three statistics come
    from one state of the posts (:func:`quarry.operators.mentions.mention_state`)."""
    state = mx.mention_state(posts, year) if state is None else state
    topics = mx.topic_stats_frame_of(state).toDF(*TOPIC_HEADERS)
    pubs = mx.publications(posts).toDF(*PUBLICATION_HEADERS)
    monthly = mx.monthly_matrix_of(state).withColumnRenamed("university", MONTHLY_TOPIC_HEADER)
    return {SHEET_OVERALL: mx.overall_stats_of(state), SHEET_TOPICS: topics,
            SHEET_PUBLICATIONS: pubs, SHEET_MONTHLY: monthly}


def write_report(posts: DataFrame, out_dir: str, year: int, fmt: str = "parquet") -> dict[str, str]:
    """Write every table under ``out_dir/<sheet dir>``; returns the paths ({} if empty).  The posts
    are scanned once for the statistics, whose state is written, and once for the publications,
    which are a copy of them; nothing is persisted."""
    state = written(posts.sparkSession, mx.mention_state(posts, year), "report-state")
    if state.isEmpty():
        return {}
    paths = {}
    for sheet, df in report_tables(posts, year, state).items():
        path = f"{out_dir.rstrip('/')}/{SHEET_DIRS[sheet]}"
        df.write.mode("overwrite").format(fmt).save(path)
        paths[sheet] = path
    return paths
