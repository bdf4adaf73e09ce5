"""Native column functions: text, URLs, dates, records."""
