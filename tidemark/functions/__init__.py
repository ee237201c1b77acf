"""Column helpers: clocks, numbers, text and encodings. Nothing here starts a job."""
