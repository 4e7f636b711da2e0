"""Column functions: text, codes, urls and content ids."""
