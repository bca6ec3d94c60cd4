"""Labelled pages for the content model: ``data-y="1"`` marks the main text, all else is page furniture."""

PAGES = [
    """<html><head><title>Storm</title><style>p{}</style></head><body><header><a href="/">Daily</a><p>News since 1901, every day of the week.</p></header>
    <nav><ul><li><a href="/a">World</a></li><li><a href="/b">Sport</a></li></ul></nav>
    <main><article><h1 data-y="1">Storm reaches the coast</h1><p data-y="1">The storm reached the coast on Monday. Roads were closed, and trains did not run.</p>
    <p data-y="1">Officials said that they would open shelters.</p><blockquote data-y="1">We are safe, she said.</blockquote>
    <div class="ad"><p>Buy a new car today. Offers end on Sunday.</p></div><ul><li data-y="1">Take water with you.</li><li data-y="1">Stay at home.</li></ul></article></main>
    <aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten tips for spring</a></li></ul><p>Our editors choose the best stories for you.</p></aside>
    <section class="comments"><h3>Comments</h3><div class="comment"><p>I was there. It was a very long night for all of us.</p></div></section>
    <footer><p>All rights reserved. Write to us at any time.</p></footer></body></html>""",
    """<html><body><div id="header"><span>Recipes</span></div><div class="menu"><a href="/x">Soups</a> <a href="/y">Cakes</a></div>
    <div class="content"><h2 data-y="1">Bread</h2><p data-y="1">Mix the flour with water. Wait for an hour, then bake it.</p><p data-y="1">Eat it warm.</p>
    <table><tr><td data-y="1">Flour</td><td data-y="1">500 g</td></tr></table></div>
    <div class="cookie-notice"><p>We use cookies. By going on you agree to that, in full.</p><button>Accept</button></div>
    <form class="newsletter"><label>Your address</label><input><p>Get our letter every week, free of charge.</p></form>
    <div id="footer">Imprint, contact and terms of use.</div></body></html>""",
    """<html><body><nav class="breadcrumb"><a href="/">Home</a></nav><article class="post"><h1 data-y="1">On rivers</h1><p data-y="1">Rivers carry sand to the sea.</p>
    <p data-y="1">Some of them are old.</p><aside><p>Read also: a story about lakes and their names.</p></aside><p data-y="1">Others change their beds each year.</p>
    <div class="share"><a href="#">Share this</a></div></article><div class="related"><p>Mountains grow slowly, they say. A long read.</p></div>
    <div class="ad">Cheap flights to the south, from nine euros.</div><footer>&copy; Rivers</footer></body></html>""",
    """<html><body><div class="banner">Sale ends soon. Everything must go.</div><div><h1 data-y="1">A letter</h1><p data-y="1">Dear friend, I am writing to you from the mountains, where it snows.</p>
    <p data-y="1">The house is small, but it has a stove. We read a lot.</p><p data-y="1">Yours.</p></div>
    <div class="popup"><p>Join now, and save a third of the price in the first year.</p></div><div class="footer"><p>Made with care. Version 3 of this page.</p></div></body></html>""",
    """<html><body><ul class="nav"><li><a href="/1">One</a></li><li><a href="/2">Two</a></li><li><a href="/3">Three</a></li></ul><main><p data-y="1">Only one paragraph stands here, and it says little.</p></main>
    <div role="contentinfo"><p>Terms and privacy. Contact us for more.</p></div></body></html>""",
    """<html><body><header><h1>Forum</h1></header><div class="entry"><p data-y="1">How do I mend a bike? The chain falls off when I stop.</p><pre data-y="1">click clack</pre></div>
    <div id="comments"><p>Use a new chain. That is what I did, and it holds.</p><p>Or walk.</p></div><form><textarea>Your answer</textarea><button>Send</button></form></body></html>""",
]
