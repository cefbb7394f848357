"""Fraud, spam and phishing analytics over message tables, built on Spark DataFrames."""
