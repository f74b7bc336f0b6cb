"""Training-data operators: tokens, mixing, shards, quality, secrets, pages, chats, languages, neighbours, near copies."""
