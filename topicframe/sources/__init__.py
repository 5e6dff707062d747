"""Topic sources: the topic-table reader/writer and Kafka option builders."""
