"""Training-data operators: packing, chat formatting, benchmark decontamination,
URL filtering, secret scanning, adaptive quality rules, WARC archives, SimHash
near-duplicates, k-d tree sharding, binary token records, conversation prefix
tries, nearest neighbours and importance resampling.

Every operator takes and returns DataFrames, reads only the columns it is told
to (extra columns with any name are carried or ignored, never confused with its
own), and treats each row as a document of its own, repeated rows included.
"""
