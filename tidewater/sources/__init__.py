"""Where rows come from: literals, files, sockets, message topics, databases."""
