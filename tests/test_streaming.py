"""The row-level steps are plain column expressions, so they run unchanged on
a streaming DataFrame (the reference itself has no streaming part)."""

import os
import tempfile

from sparkfit.operators import clean_rows


def test_clean_rows_on_a_text_stream(spark):
    src = tempfile.mkdtemp(prefix="sparkfit-stream-src-")
    with open(os.path.join(src, "part-0.txt"), "w") as fh:
        fh.write("app,a,b,rating,rc,x,mi,ma,y,price\n")
        fh.write("Alpha,t,c,4.5,10,x,100,1000,y,0\n")
        fh.write("Beta,t,c,n/a,10,x,100,1000,y,0\n")
    stream = spark.readStream.format("text").load(src)
    q = (clean_rows(stream).writeStream.format("memory").queryName("cleaned_stream")
         .outputMode("append").start())
    try:
        q.processAllAvailable()
        rows = spark.sql("SELECT app, rating FROM cleaned_stream").collect()
    finally:
        q.stop()
    assert [(r["app"], r["rating"]) for r in rows] == [("Alpha", 4.5)]
