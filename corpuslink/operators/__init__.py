"""DataFrame operators: search, prefix dictionary, text models, linkage, crawl, index."""
