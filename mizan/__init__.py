"""mizan: bilingual legal-document structuring on Spark DataFrames."""
