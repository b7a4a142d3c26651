"""A small table of labelled urls: the default training data of the url filter.

All sites are invented and lie under reserved top-level names. No site has two lines. Words of the
unwanted trades stand among the ordinary sites too (library loans, a county with "sex" in its name,
a card-game history), so that a word list alone would not do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKED = """
https://casino-royal-slots.example/bonus/free-spins
http://megaslots-casino.test/play/jackpot
https://www.luckybet-casino.example/register?ref=77
http://online-casino-winners.test/slots/no-deposit-bonus
https://vipcasino.example/en/live-roulette
http://jackpot-slots-party.test/free-spins/today
https://slots4win.example/casino/bonus
http://www.bigwin-jackpots.test/play-now
https://bet-and-win-today.example/sports-betting/odds
http://bestbets.test/betting/bonus-code
https://livebetting-king.example/bet/football
http://betzone.test/register/free-bet
https://superbet-odds.example/betting-tips
http://royal-poker-room.test/play/texas-holdem
https://poker-stars-cash.example/bonus/deposit
http://free-poker-chips.test/hack
https://www.pokerbonus.example/casino/poker
http://roulette-wins.test/casino/strategy
https://bingo-bonus-club.example/play/free
http://gamblers-gold.test/casino/slots/777
https://online-gambling-guide.example/casino-bonus
http://cheap-viagra-shop.test/buy-viagra-online
https://viagra-without-prescription.example/order
http://buy-cialis-now.test/cheap/cialis-20mg
https://www.cialis-discount.example/buy/online
http://pills-express.test/buy/diet-pills
https://dietpills-miracle.example/weight-loss/fast
http://buypills24.test/order/no-prescription
https://canadian-pharmacy-pills.example/cheap-meds
http://onlinepharmacy-rx.test/buy/tramadol-online
https://rx-meds-cheap.example/no-prescription/xanax
http://cheapmeds.test/order/viagra
https://slim-fast-pills.example/buy-now/discount
http://male-enhancement-pills.test/buy/free-trial
https://xanax-overnight.example/buy-online
http://steroids-shop.test/buy/anabolic
https://hot-sex-cams.example/live/girls
http://freesexvideos.test/xxx/teen
https://www.xxx-tube-free.example/videos/porn
http://porn-hd-streams.test/watch/xxx
https://pornvideos.example/free/hardcore
http://adult-webcam-girls.test/chat/live
https://live-cam-girls.example/adult/chat
http://sexdating-tonight.test/meet/singles
https://hot-singles-nearby.example/adult/dating
http://adultdating.test/hookup/tonight
https://nude-celebs.example/xxx/gallery
http://escort-girls-city.test/vip-escorts
https://vipescorts.example/girls/book-now
http://milf-porn.test/free-xxx-videos
https://fetish-xxx.example/adult/pics
http://hookup-fast.test/adult/sex-chat
https://payday-loans-fast.example/apply-now/bad-credit
http://instant-payday-cash.test/loan/no-credit-check
https://www.quickloans.example/apply/payday
http://badcredit-loans-now.test/instant-approval
https://cash-advance-online.example/payday-loan
http://easyloans24.test/no-credit-check/apply
https://instant-cash-loans.example/approval
http://debt-relief-fast.test/apply-now/free
https://bitcoin-doubler.example/invest/profit
http://crypto-profit-now.test/earn/bitcoin-fast
https://earn-money-fast.example/work-from-home/profit
http://get-rich-quick.test/earn/cash-daily
https://makemoneyonline.example/earn-fast/secret
http://forex-profit-robot.test/earn/invest
https://free-bitcoin-generator.example/claim
http://crypto-giveaway.test/claim/free-bitcoin
https://win-free-iphone.example/claim-prize/winner
http://claim-your-prize.test/winner/gift-card
https://free-gift-cards.example/claim/survey
http://lucky-winner-prize.test/survey/claim-now
https://freegiftcard-generator.example/hack/claim
http://replica-watches-shop.test/buy/rolex-replica
https://cheap-replica-bags.example/buy/gucci-replica
http://replicarolex.test/cheap/watches
https://fake-designer-bags.example/replica/cheap
http://cheap-handbags-outlet.test/replica/discount
https://warez-download.example/crack/keygen
http://free-keygen-crack.test/download/serial
https://cracked-software.example/download/full-crack
http://crackedgames.test/torrent/free-download
https://torrent-movies-free.example/download/full-hd
http://free-movie-torrents.test/watch/stream-hd
https://pirate-streams.example/torrent/watch-free
http://serial-keys.test/keygen/crack-download
https://buy-backlinks-cheap.example/seo/link-spam
http://seo-backlinks-blast.test/buy/links
https://buyfollowers.example/cheap/instagram-followers
http://cheap-likes-followers.test/buy/now
https://bulk-email-spam.example/buy/email-list
http://spammer-tools.test/bulk/mailer-crack
https://secure-login-verify.example/account/update-password
http://account-verify-bank.test/login/confirm-password
https://verify-paypa1-account.example/login/secure-update
http://bank-login-update.test/secure/verify-account
"""

ALLOWED = """
https://www.riverside-university.example/departments/history
http://chemistry.northfield-university.test/courses/organic
https://eastbourne-college.example/students/handbook
http://www.hillview-school.test/parents/term-dates
https://open-lectures.example/mathematics/linear-algebra
http://physics-notes.test/waves/chapter-3
https://citylibrary.example/loans/renew
http://www.county-library.test/catalogue/new-books
https://national-archive.example/records/1871-census
http://museum-of-printing.test/exhibitions/type
https://art-gallery.example/collection/watercolours
http://www.folk-museum.test/visit/opening-hours
https://weather-service.example/forecast/coast
http://mountainweather.test/snow/avalanche-report
https://climate-data.example/stations/rainfall.csv
http://tides-and-winds.test/harbour/2024-05-02
https://garden-notes.example/roses/pruning
http://www.allotment-diary.test/vegetables/beans
https://beekeepers-society.example/hives/swarming
http://birdwatching-club.test/sightings/october
https://wildflower-guide.example/meadow/identification
http://www.tree-register.test/oaks/oldest
https://slow-cooker-recipes.example/soup/lentil
http://bread-baking.test/sourdough/starter
https://www.grandmas-kitchen.example/recipes/apple-pie
http://vegan-table.test/dinner/curry
https://cheese-makers.example/how-to/cheddar
http://teahouse-journal.test/oolong/brewing
https://python-handbook.example/docs/iterators
http://docs.webserver.test/manual/configuration
https://open-database.example/docs/reference/select
http://compiler-notes.test/articles/register-allocation
https://www.linux-users.example/wiki/filesystems
http://bugs.editor-project.test/issues/4312
https://code-review-blog.example/posts/testing
http://mailing-list.test/archives/2019-march/0042.html
https://evening-gazette.example/news/council-budget
http://www.daily-courier.test/sport/cricket/report
https://local-radio.example/programmes/morning
http://world-news-digest.test/europe/elections
https://science-weekly.example/articles/black-holes
http://www.economics-review.test/issues/inflation
https://townhall.example/services/recycling
http://parliament-records.test/debates/1998-11-03
https://essex-county.example/council/planning
http://www.sussex-walks.test/routes/downs
https://tax-office.example/forms/self-assessment
http://post-service.test/parcels/track
https://public-health.example/vaccination/schedule
http://www.hospital-trust.test/patients/visiting
https://pharmacology-institute.example/research/antibiotics
http://nurses-forum.test/topics/shift-work
https://child-nutrition.example/advice/breakfast
http://first-aid-course.test/lessons/burns
https://railway-timetable.example/stations/central
http://bus-routes.test/lines/42
https://www.island-ferries.example/timetable/summer
http://cycling-atlas.test/tours/danube
https://hostel-guide.example/mountains/huts
http://old-town-hotel.test/rooms/breakfast
https://travel-letters.example/japan/kyoto-temples
http://sailing-school.test/courses/navigation
https://chess-club.example/tournaments/results
http://www.athletics-league.test/fixtures/june
https://football-history.example/clubs/founded-1880
http://rowing-club.test/regatta/photos
https://bridge-players.example/lessons/bidding
http://card-game-history.test/poker/origins
https://choir-festival.example/programme/bach
http://guitar-lessons.test/chords/minor
https://www.jazz-archive.example/recordings/1959
http://theatre-company.test/plays/tickets
https://film-society.example/reviews/silent-era
http://poetry-review.test/poems/autumn
https://book-reviews.example/novels/short-stories
http://www.comics-library.test/artists/inking
https://language-exchange.example/german/grammar
http://latin-reader.test/texts/caesar
https://dictionary.example/entry/serendipity
http://encyclopedia.test/article/photosynthesis
https://knitting-patterns.example/jumpers/cable
http://woodworking-shop.test/joints/dovetail
https://www.pottery-class.example/glazes/celadon
http://bicycle-repair.test/guides/brakes
https://home-insulation.example/advice/loft
http://house-painters.test/colours/kitchen
https://astronomy-society.example/observing/saturn
http://www.geology-maps.test/sheets/limestone
https://satellite-images.example/gallery/deltas
http://oceans-lab.test/papers/currents
https://family-history.example/surnames/smith
http://village-church.test/events/harvest
https://parents-forum.example/topics/bedtime
http://dog-training.test/puppies/recall
https://credit-union.example/members/annual-meeting
http://consumer-advice.test/mortgages/fixed-rates
"""

HELD_OUT_ONE_IN = 4


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label, held_out): label 1 is to be blocked; a hash of the site deals one in four sites
    to the part that no model is fitted on."""

    def lines(text: str, label: float) -> DataFrame:
        urls = F.explode(F.array(*[F.lit(line) for line in text.split()]))
        return spark.range(0, 1, 1, 1).select(urls.alias("url"), F.lit(label).alias("label"))

    site = F.regexp_extract("url", r"://([^/]+)", 1)
    rows = lines(BLOCKED, 1.0).union(lines(ALLOWED, 0.0))
    return rows.withColumn("held_out", F.pmod(F.crc32(site), F.lit(HELD_OUT_ONE_IN)) == 0)
