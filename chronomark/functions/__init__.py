"""Column functions: time, text, statistics and classes. All of them stay in generated code."""
