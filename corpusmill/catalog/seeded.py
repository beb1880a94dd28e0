"""The documents with features added that the tables lack (signatures, URLs, code,
nulls, ...). Whole texts are kept. The same SQL runs in Spark and in DuckDB."""

SEEDED_SQL = """
SELECT doc_id, lang, source,
  CASE doc_id % 12
    WHEN 0 THEN concat('Can you explain ', text, '?')
    WHEN 1 THEN concat('CONFIDENTIAL ', text, chr(10), 'Best regards,', chr(10), 'A. Person')
    WHEN 2 THEN concat('See https://example.com/a/b?x=1%20y#z and ', text)
    WHEN 3 THEN concat('```x = @@@@;``` ', text, ' `y@#`')
    WHEN 4 THEN concat('“Quoted” and ‘single’ ', text)
    WHEN 5 THEN concat('a', chr(10), '  ', chr(10), chr(10), 'b    c', chr(9), text)
    WHEN 6 THEN replace(text, ' ', '@#%^&*= ')
    WHEN 7 THEN concat('This is wonderful news for EUROPE and the MIDDLE EAST. ', text)
    WHEN 8 THEN concat('This is terrible and disappointing. ', text)
    WHEN 9 THEN NULL
    WHEN 10 THEN concat('list and describe the words: aaaaaaa ', text)
    ELSE text END AS text,
  CASE doc_id % 4 WHEN 0 THEN concat('user', doc_id, '@example.com') WHEN 1 THEN 'not-an-email'
    WHEN 2 THEN NULL ELSE 'invalid@' END AS email,
  CASE doc_id % 3 WHEN 0 THEN '+1234567890' WHEN 1 THEN '123' ELSE '1234567890' END AS phone,
  CASE doc_id % 5 WHEN 0 THEN '2024-02-01' WHEN 1 THEN '2024/01/01' ELSE '2024-01-02' END AS start_date,
  CASE doc_id % 7 WHEN 0 THEN 'invalid-date' ELSE '2024-01-31' END AS end_date
FROM {documents}
"""
