"""Schemas of the typed records."""

RECORD_SCHEMA = (
    "book_id string, metadata map<string,string>, sentiment map<string,double>, "
    "syntactic map<string,double>, total_word_count bigint, unique_word_count bigint, "
    "top_words array<struct<word:string,count:bigint>>"
)

FACT_COLUMNS = ("book_id", "component", "metric", "value")

SUMMARY_SCHEMA = (
    "component string, version int, input_lines bigint, books_aggregated bigint, "
    "dropped_lines bigint, dropped_by_reason map<string,bigint>, "
    "by_cohort map<string, struct<cohort:string, n_books:bigint, means:map<string,double>, "
    "syntactic_means:map<string,double>, sums:map<string,double>>>, "
    "comparison struct<mean_deltas_bestseller_minus_standard:map<string,double>, "
    "direction:map<string,string>, "
    "syntactic_mean_deltas:map<string,struct<delta:double,direction:string>>>"
)
