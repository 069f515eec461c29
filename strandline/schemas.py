"""Schemas of the engine's tables."""

# Columns of the raw candidate file, in its order.
CANDIDATES_RAW = (
    "cand_id string, cand_name string, cand_pty_affiliation string, cand_election_yr string, cand_office_st string, "
    "cand_office string, cand_office_district string, cand_ici string, cand_status string, cand_pcc string, "
    "cand_st1 string, cand_st2 string, cand_city string, cand_st string, cand_zip string"
)
ROSTER = "candidate string, state string, district string, office string, year int, party string, website_url string"
CAPTURES = "timestamp string, original_url string, statuscode string, mimetype string"
PAGE_STORE = "url string, html string"
PAGE_ROWS = "candidate string, state string, district string, office string, year int, party string, stage int, date string, urlkey string, snap_url string, page_type string, data_source string, n_tags int, n_clean_tags int, text_snap_content string, n_char int, n_words int"
PROGRESS = "url string, candidate string, state string, office string, year int, scrape_complete int, scrape_error int, batch string"
URL_CACHE = "candidate string, state string, year string, url string, cached_at string"
LABELS = "snap_url_pattern string, page_type_llm string, labelled_at timestamp"
COMMITTEE_ANSWER = "results array<struct<website: string>>"
